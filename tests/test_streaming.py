"""Structured Streaming: decode, batch = stream, restart, retries, progress."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from reelstats.sources import fixtures
from reelstats.streaming import decode, runner
from reelstats.streaming.recommend import (
    batch_recommendations,
    parquet_batch_writer,
    recommendation_batch_handler,
)
from tests.conftest import SMALL_SF_DIR, rows


def _tmp():
    return tempfile.mkdtemp(prefix="reelstats-stream-")


def test_decode_messages(spark):
    msgs = spark.createDataFrame(
        [
            (1, '{"userId": 1, "movieId": 2, "rating": 3.5, "timestamp": 1700000000}'),
            (2, '{"userId": 1, "movieId": 3, "rating": 4.0, "timestamp": "2023-11-14T22:13:20Z"}'),
            (3, '{"userId": 1, "rating": 4.0}'),
            (4, '{"userId": "x", "movieId": 3, "rating": 4.0, "timestamp": 1}'),
            (5, "not-json"),
            (6, None),
        ],
        "id int, value string",
    )
    out = {r["id"]: r for r in decode.decode_json(msgs, keep=("id",)).collect()}
    assert (out[1]["userId"], out[1]["movieId"], out[1]["rating"]) == (1, 2, 3.5)
    assert out[1]["timestamp"] == out[2]["timestamp"]  # epoch seconds and text agree
    assert out[3]["movieId"] is None and out[3]["userId"] == 1
    assert out[4]["userId"] is None
    assert all(out[i]["userId"] is None for i in (5, 6))
    assert decode.valid_events(decode.decode_json(msgs)).count() == 2


def _decoded_stream(spark, max_files=1):
    return decode.decode_json(
        fixtures.rating_messages(spark, SMALL_SF_DIR, fixtures.events_stream(spark, SMALL_SF_DIR, max_files)),
        keep=("event_id",),
    )


def test_stream_decode_equals_batch_and_restart_adds_nothing(spark):
    out = _tmp()
    for _ in range(2):  # second run: same checkpoint, nothing new to read
        q = runner.start_sink(_decoded_stream(spark), "parquet", checkpoint=f"{out}/ckpt",
                              path=f"{out}/data", trigger={"availableNow": True})
        runner.drain(q)
    streamed = spark.read.parquet(f"{out}/data")
    batch = decode.decode_json(fixtures.rating_messages(spark, SMALL_SF_DIR), keep=("event_id",))
    assert streamed.count() == batch.count() == 1000
    assert rows(streamed) == rows(batch.select(*streamed.columns))


def test_progress_counts_every_input_row(spark):
    out = _tmp()
    q = runner.start_sink(_decoded_stream(spark), "parquet", checkpoint=f"{out}/ckpt",
                          path=f"{out}/data", trigger={"availableNow": True})
    runner.drain(q)
    prog = runner.progress_frame(spark, q)
    assert prog.agg(F.sum("numInputRows")).first()[0] == 1000


class _Model:
    """Stand-in with the one method the batch handler uses: every known user
    gets the same scored items."""

    def __init__(self, spark, known):
        self.spark, self.known = spark, known

    def recommendForUserSubset(self, users, k):  # noqa: N802 (the model's API name)
        known = self.spark.createDataFrame([(u,) for u in self.known], "userId int")
        items = F.array(*[F.struct(F.lit(i).alias("movieId"), F.lit(float(10 - i)).alias("rating"))
                          for i in range(k)])
        return users.join(known, "userId", "left_semi").select("userId", items.alias("recommendations"))


def test_batch_handler_is_idempotent_and_skips_empty(spark):
    out = _tmp()
    model = _Model(spark, known=[1, 2])
    handler = recommendation_batch_handler(model, parquet_batch_writer(out, "run"), k=5)
    batch = spark.createDataFrame([(1, 5), (1, 6), (2, 7), (3, 8), (None, 9)], "userId int, movieId int")
    handler(batch, 0)
    handler(batch, 0)  # a retried batch replaces its own partition
    handler(batch.where("userId < 0"), 1)  # empty: nothing written
    recs = spark.read.parquet(out)
    assert recs.count() == 10
    (run,) = [d for d in os.listdir(out) if d.startswith("run_id=")]
    assert [d for d in os.listdir(f"{out}/{run}") if d.startswith("batch_id=")] == ["batch_id=0"]


def test_failing_sink_is_retried_not_lost(spark):
    out, ckpt = _tmp(), _tmp()
    model = _Model(spark, known=list(range(200)))
    state = {"fail": True}
    write_ok = parquet_batch_writer(out, "run")

    def flaky(df):
        if state["fail"]:
            raise RuntimeError("sink down")
        write_ok(df)

    q = runner.start_foreach_batch(_decoded_stream(spark), recommendation_batch_handler(model, flaky, 5),
                                   ckpt, trigger={"availableNow": True})
    with pytest.raises(Exception):
        runner.drain(q)
    state["fail"] = False
    q = runner.start_foreach_batch(_decoded_stream(spark), recommendation_batch_handler(model, flaky, 5),
                                   ckpt, trigger={"availableNow": True})
    runner.drain(q)
    expected_users = decode.valid_events(
        decode.decode_json(fixtures.rating_messages(spark, SMALL_SF_DIR))).select("userId").distinct().count()
    assert spark.read.parquet(out).count() == 5 * expected_users


def test_batch_recommendations_columns(spark):
    model = _Model(spark, known=[1])
    df = batch_recommendations(model, spark.createDataFrame([(1, 3)], "userId int, movieId int"), 7, k=2)
    assert df.columns == ["userId", "movieId", "rating", "processing_time", "batch_id"]
    assert {r["batch_id"] for r in df.collect()} == {7}


def test_key_value_decode_and_kafka_options(spark):
    raw = spark.createDataFrame([(b"k", b"v")], "key binary, value binary")
    assert rows(decode.decode_key_value(raw)) == [("k", "v")]
    opts = decode.kafka_options("broker:9092", "movie_rating")
    assert opts == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "movie_rating",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }


def test_poll_progress_reports_while_running(spark):
    out = _tmp()
    q = runner.start_sink(_decoded_stream(spark), "parquet", checkpoint=f"{out}/ckpt", path=f"{out}/data",
                          trigger={"processingTime": "200 milliseconds"})
    try:
        q.processAllAvailable()
        seen = []
        assert runner.poll_progress(q, 0.05, seen.append, max_polls=3) >= 1
        assert {"batchId", "numInputRows", "processedRowsPerSecond"} <= set(seen[0])
    finally:
        runner.stop(q)
    assert not q.isActive


def test_batch_writer_keeps_both_runs_and_does_not_double_a_retry(spark, tmp_path):
    out = str(tmp_path / "recs")
    batch = spark.createDataFrame([(1, 0), (2, 0)], "userId int, batch_id long")
    for run in ("a", "b", "b"):
        parquet_batch_writer(out, run)(batch)
    assert spark.read.parquet(out).count() == 4


def test_events_stream_reads_a_folder_of_part_files(spark, tmp_path):
    from reelstats.sources import fixtures

    events = spark.read.parquet(f"{SMALL_SF_DIR}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "sf/events.parquet"))
    q = runner.start_sink(fixtures.events_stream(spark, str(tmp_path / "sf")), "parquet", checkpoint=str(tmp_path / "c"),
                          path=str(tmp_path / "o"), trigger={"availableNow": True})
    runner.drain(q)
    assert spark.read.parquet(str(tmp_path / "o")).count() == events.count()


def test_progress_totals_count_more_batches_than_are_retained(spark, tmp_path):
    retained = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(retained, 10)
    events = spark.read.parquet(f"{SMALL_SF_DIR}/events.parquet").limit(30)
    events.repartition(30, "event_id").write.option("maxRecordsPerFile", 1).parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "e"))
    with runner.progress_totals(spark) as log:
        q = runner.start_sink(stream.select("event_id"), "noop", checkpoint=str(tmp_path / "c"), trigger={"availableNow": True})
        runner.drain(q)
        assert log.totals(q) == {"batches": 30, "input_rows": 30}
    spark.conf.unset(retained)
    assert len(q.recentProgress) < 30


def test_poll_progress_raises_for_a_failed_stream(spark, tmp_path):
    from reelstats.sources import fixtures

    def fail(batch, batch_id):
        raise ValueError("broken handler")

    q = runner.start_foreach_batch(fixtures.events_stream(spark, SMALL_SF_DIR), fail, str(tmp_path / "c"), trigger={"processingTime": "0 seconds"})
    with pytest.raises(Exception, match="broken handler"):
        runner.poll_progress(q, 0.1)
