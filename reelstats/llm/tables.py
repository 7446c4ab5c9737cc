"""Input tables and written intermediate results of the llm operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.session import scratch_path

#: Stands for a null doc_id where operators compare ids: below every id.
NULL_ID = -(1 << 63)
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, row_group_bytes: int | None = None) -> DataFrame:
    """The rows, written once under the shared folder and read back: a lineage cut that survives lost executors.

    row_group_bytes bounds what a writing task buffers, for wide rows.
    """
    path = scratch_path(df.sparkSession, name)
    (df.write.option("parquet.block.size", row_group_bytes) if row_group_bytes else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_key(column: str = "doc_id"):
    return F.coalesce(F.col(column), F.lit(NULL_ID))


def shards_for(docs: DataFrame, column: str = "text", bytes_each: int = 64 << 20, least: int = 8) -> int:
    """Number of hash shards, in proportion to the bytes of a text column."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(least, -(-int(total) // bytes_each))
