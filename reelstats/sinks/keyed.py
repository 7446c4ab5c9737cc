"""Collections laid out for look-ups by key: a look-up reads one bucket, and of its files only the
row groups and pages that may hold the key.

Rows are hashed into buckets by the key and sorted by it inside each file. Spark's
bucket pruning picks the bucket's files, the sorted order makes row group and page
statistics narrow, and a Bloom filter on the key drops files for ids that don't exist.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 2000


def write_keyed(df: DataFrame, table: str, path: str, key: str, buckets: int = 64, keys_per_file: int = 100_000, pieces: int = 1,
                row_group_bytes: int = ROW_GROUP_BYTES, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Writes df as the bucketed, sorted table `table` under `path` (overwriting it) and returns the table.

    keys_per_file: expected distinct keys in a file, sizes its Bloom filter. pieces: files per
    bucket; with more than one, a key with very many rows is spread over that many tasks.
    """
    others = [c for c in df.columns if c != key]
    piece = F.pmod(F.xxhash64(*others), F.lit(pieces)) if others else F.lit(0)
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # the rule that bucketBy puts rows into buckets by
    (
        df.repartition(buckets * pieces, bucket, piece).write.mode("overwrite").format("parquet").option("path", path)
        .option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", str(keys_per_file))
        # a dictionary would stand in for the Bloom filter in the writer
        .option(f"parquet.enable.dictionary#{key}", "false")
        .option("parquet.block.size", row_group_bytes).option("parquet.page.row.count.limit", page_rows)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    )
    return df.sparkSession.table(table)


def open_keyed(spark: SparkSession, table: str, path: str, schema: StructType, key: str, buckets: int = 64) -> DataFrame:
    """Names the files that another application wrote with `write_keyed` as a table of this one."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)


def find_key(collection: DataFrame, key: str, value: Any) -> DataFrame:
    """Rows of one key: reads one bucket, and nothing of it where the Bloom filter says that the key is not there."""
    return collection.where(F.col(key) == F.lit(value))


def key_exists(collection: DataFrame, key: str, value: Any) -> bool:
    return not find_key(collection, key, value).isEmpty()
