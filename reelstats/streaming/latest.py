"""Each user's newest recommendations, held in the streaming state of the user.

The sink of the per-batch recommender appends every batch, so serving from it
reads all batches ever written. Here a stateful operator keyed by user keeps only the
newest batch's k best, and serving reads that state: one row a user. State is
partitioned by user, checkpointed with the stream, and picked up on a restart.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from reelstats.operators.serving import lookup_movies, serve_recommendations

STATE = "newest"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _worst_first(rec: tuple) -> tuple:
    movie, rating = rec
    return (float("-inf") if rating is None else rating, -movie)


class NewestTop(StatefulProcessor):
    """State of a user: the newest batch id and its k best (movieId, rating). Rows of older batches
    change nothing, whenever they come; rows of the newest add to it."""

    def __init__(self, k: int):
        self.k = k

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState(STATE, "batch_id long, top array<struct<movieId:int,rating:float>>")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 (the processor's API names)
        batch, top = self.newest.get() if self.newest.exists() else (None, [])
        top = [(t["movieId"], t["rating"]) for t in top]
        before = (batch, top)
        for r in rows:  # k are held, however many there are
            if batch is None or r["batch_id"] > batch:
                batch, top = r["batch_id"], []
            if r["batch_id"] == batch:
                top = heapq.nlargest(self.k, [*top, (r["movieId"], r["rating"])], key=_worst_first)
        if (batch, top) != before:
            self.newest.update((batch, top))
            yield Row(userId=key[0], batch_id=batch, n=len(top))

    def close(self) -> None:
        pass


def newest_per_user(recs: DataFrame, k: int = 5) -> DataFrame:
    """Stream of (userId, batch_id, n): users whose newest recommendations changed.

    recs: a stream of userId, movieId, rating, batch_id. Rows without a user, movie or batch are left out.
    """
    known = recs.select("userId", "movieId", F.col("rating").cast("float").alias("rating"), "batch_id").na.drop(subset=["userId", "movieId", "batch_id"])
    return known.groupBy("userId").transformWithState(
        statefulProcessor=NewestTop(k), outputStructType="userId int, batch_id long, n int", outputMode="Update", timeMode="None"
    )


@contextmanager
def _keyed_state(spark: SparkSession):
    """A query started inside keeps its state in RocksDB, which this kind of operator needs."""
    old = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if old is None else spark.conf.set(_PROVIDER, old)


def start_newest(recs: DataFrame, checkpoint: str, k: int = 5, trigger: dict | None = None, fmt: str = "noop") -> StreamingQuery:
    """Keeps the state of `newest_per_user` under `checkpoint`; fmt gets the changes (default: nowhere)."""
    with _keyed_state(recs.sparkSession):
        return (
            newest_per_user(recs, k).writeStream.outputMode("update").format(fmt)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "10 seconds"})).start()
        )


def read_newest(spark: SparkSession, checkpoint: str) -> DataFrame:
    """userId, batch_id, movieId, rating, rank from the state as of the last finished batch."""
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    rows = state.select(F.col("key.userId").alias("userId"), F.col("value.batch_id").alias("batch_id"), F.posexplode("value.top").alias("_pos", "_rec"))
    return rows.select("userId", "batch_id", F.col("_rec.movieId").alias("movieId"), F.col("_rec.rating").alias("rating"), (F.col("_pos") + 1).alias("rank"))


def serve_newest(spark: SparkSession, checkpoint: str, movies: DataFrame, **lookup) -> DataFrame:
    """The page of stored recommendations (as `serving.user_top_recommendations`) from the state."""
    return serve_recommendations(lookup_movies(read_newest(spark, checkpoint), movies, ["title", "genres"], **lookup))
