"""Token-id output as Parquet list columns (operator 2).

Texts (null: empty) are range-partitioned by doc_id, sorted, encoded whole in
that order, and written as rows (doc_id, n_tokens, ids_crc32, file_start,
token_ids); end_id closes each document. So the files, in order of their first
doc_id, hold the corpus in order. Layout of the files:

* token_ids is list<int> with dictionary pages, falling back to delta binary
  packing (format v2 pages) where the dictionary grows too large; doc_id and
  n_tokens are delta-packed too;
* row groups of `row_group_bytes`, pages of `page_bytes`, with page indexes
  (min/max per page), so a read of some doc_ids or of the metadata columns
  alone touches only those pages.

`read_index` reads the files back and gives each document's `start`, the ids
of all documents before: file_start, the running sum inside the file, plus the
sums of the files before it (one row per file). Rows that repeat a doc_id are
ordered by a hash of the text; a null doc_id comes first. Empty tables give an
empty file set and result; extra input columns are not written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelstats.llm import arrowtext as at
from reelstats.llm.tables import id_key
from reelstats.llm.tokens import CHUNK_BYTES, Encoder

_SCHEMA = "doc_id long, n_tokens long, ids_crc32 long, file_start long, token_ids array<int>"


def encode(docs: DataFrame, tokenizer: str, end_id: int, added_tokens: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, file_start (running sum of the partition), token_ids; added_tokens as in Encoder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, done = Encoder(tokenizer, added_tokens), 0
        for batch in batches:
            for part in at.chunks(batch, "text", CHUNK_BYTES):
                ids, off = coder.with_end(part.column("text"), end_id)
                lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.view(np.int32)))
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(off[:-1], off[1:])]
                yield pa.record_batch(
                    [part.column("doc_id"), pa.array(np.diff(off)), pa.array(crc, pa.int64()), pa.array(done + off[:-1]), lists],
                    names=["doc_id", "n_tokens", "ids_crc32", "file_start", "token_ids"],
                )
                done += int(off[-1])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, added_tokens: bool = False) -> None:
    in_order = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    )
    (
        encode(in_order, tokenizer, end_id, added_tokens)
        .write.option("parquet.block.size", row_group_bytes)
        .option("parquet.page.size", page_bytes)
        .option("parquet.dictionary.page.size", 1 << 20)
        .option("parquet.enable.dictionary", "true")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, the last two computed from the ids read."""
    stored = read_tokens(spark, path).withColumn("_file", F.input_file_name())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            off = lists.offsets.to_numpy()
            ids = lists.values.to_numpy(zero_copy_only=False).view(np.uint32)
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(off[:-1], off[1:])]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("file_start"), pa.array(np.diff(off).astype(np.int64)), pa.array(crc, pa.int64()), batch.column("_file")],
                names=["doc_id", "file_start", "n_tokens", "ids_crc32", "_file"],
            )

    rows = stored.select("doc_id", "file_start", "token_ids", "_file").mapInArrow(
        digest, "doc_id long, file_start long, n_tokens long, ids_crc32 long, _file string"
    )
    files = stored.groupBy("_file").agg(F.min(id_key()).alias("_first"), F.max(id_key()).alias("_last"), F.sum("n_tokens").alias("_sum"))
    earlier = W.orderBy("_first", "_last", "_file").rowsBetween(W.unboundedPreceding, -1)
    before = files.select("_file", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(before, "_file").select("doc_id", (F.col("_before") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32")
