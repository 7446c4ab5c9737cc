"""Per-micro-batch recommendations (foreachBatch) with an idempotent sink."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.operators.recommend import recommend_batch_users
from reelstats.streaming.decode import valid_events


def batch_recommendations(model: ALSModel, batch: DataFrame, batch_id: int, k: int = 5) -> DataFrame:
    """Top-k for each distinct known user of the batch, tagged with time and batch id."""
    users = valid_events(batch).select("userId")
    return (
        recommend_batch_users(model, users, k)
        .select("userId", "movieId", "rating")
        .withColumn("processing_time", F.current_timestamp())
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
    )


def parquet_batch_writer(path: str, run: str) -> Callable[[DataFrame], None]:
    """Writes each batch into its own `run_id=/batch_id=` folder, replacing only that
    folder: a retried batch overwrites its first attempt instead of adding rows.

    `run` names what numbers the batches, the stream's checkpoint location: batch
    ids start at 0 with each new one, and stay the same when a stream restarts.
    """
    run_id = hashlib.md5(run.encode()).hexdigest()[:16]

    def write(df: DataFrame) -> None:
        (
            df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("run_id", "batch_id")
            .parquet(path)
        )

    return write


def format_batch_writer(fmt: str, options: dict[str, str] | None = None) -> Callable[[DataFrame], None]:
    """Appends each batch through any batch writer format (e.g. a document store)."""

    def write(df: DataFrame) -> None:
        df.write.format(fmt).mode("append").options(**(options or {})).save()

    return write


def recommendation_batch_handler(model: ALSModel, write: Callable[[DataFrame], None], k: int = 5):
    """foreachBatch callback: skip empty batches, recommend, write.

    Errors are not swallowed: the batch fails, the checkpoint does not advance
    and the batch is run again on restart.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        # kept for the emptiness test and the write, so that the source is read once
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not batch.isEmpty():
                write(batch_recommendations(model, batch, batch_id, k))
        finally:
            batch.unpersist()

    return handle
