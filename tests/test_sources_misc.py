"""Readers, guards, look-ups and stream plumbing not covered elsewhere."""

from __future__ import annotations

import os
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from reelstats import schemas
from reelstats.sources import files
from reelstats.streaming import decode, runner
from reelstats.streaming.recommend import format_batch_writer
from tests.conftest import rows

T0 = datetime(2020, 1, 1)


def test_safe_load_wraps_failures(spark):
    with pytest.raises(files.DataLoadError, match="cannot read movies"):
        files.safe_load(spark.read.parquet, "/nonexistent/movies.parquet", error_msg="cannot read movies")
    ok = files.safe_load(spark.range, 3)
    assert ok.count() == 3


def test_find_and_find_in(spark):
    coll = spark.createDataFrame([(1, 10, 4.0, T0), (1, 11, 3.0, T0), (2, 10, 5.0, T0)], schemas.RATINGS)
    assert rows(files.find(coll, F.col("userId") == 1), ["movieId"]) == [(10,), (11,)]
    keys = spark.createDataFrame([(10,), (10,), (99,)], "movieId int")
    assert rows(files.find_in(coll, keys, "movieId"), ["userId", "movieId"]) == [(1, 10), (2, 10)]


def test_register_view_then_sql(spark):
    coll = spark.createDataFrame([(1, 10, 4.0, T0), (2, 10, 5.0, T0)], schemas.RATINGS)
    files.register_view(coll, "ratings_view_test")
    assert spark.sql("SELECT AVG(rating) AS a FROM ratings_view_test").first()["a"] == 4.5


def test_file_message_stream_with_rate_cap(spark):
    d = tempfile.mkdtemp(prefix="reelstats-msgs-")
    for i in range(3):
        with open(os.path.join(d, f"part-{i}.txt"), "w") as f:
            f.write(f'{{"userId": {i}, "movieId": 1, "rating": 4.0, "timestamp": 1700000000}}\n')
    stream = decode.decode_json(decode.read_message_stream(spark, "text", {"maxFilesPerTrigger": "1"}, path=d))
    out = tempfile.mkdtemp(prefix="reelstats-msgs-out-")
    q = runner.start_sink(stream, "parquet", checkpoint=f"{out}/ckpt", path=f"{out}/data",
                          trigger={"availableNow": True})
    runner.drain(q)
    batches = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert batches == [1, 1, 1]  # one file per trigger
    assert sorted(r["userId"] for r in spark.read.parquet(f"{out}/data").collect()) == [0, 1, 2]


def test_console_sink_runs(spark):
    stream = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    q = runner.start_sink(stream, "console", trigger={"processingTime": "100 milliseconds"})
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        runner.stop(q)


def test_format_batch_writer_appends(spark):
    d = tempfile.mkdtemp(prefix="reelstats-append-")
    write = format_batch_writer("json", {"path": d})
    df = spark.createDataFrame([(1, 2)], "userId int, movieId int")
    write(df)
    write(df)
    assert spark.read.schema("userId int, movieId int").json(d).count() == 2


def test_kafka_source_needs_its_connector(spark):
    # the connector is not installed here: the failure names the missing source
    with pytest.raises(Exception, match="(?i)kafka"):
        decode.read_message_stream(spark, "kafka", decode.kafka_options("localhost:9", "t"))


def test_genre_counts_without_genres_column(spark):
    from reelstats.operators import explore

    m = spark.createDataFrame([(1, "a")], "movieId int, title string")
    out = explore.genre_counts(m)
    assert out.columns == ["genre", "count"] and out.count() == 0


def test_cached_sample(spark):
    r = spark.createDataFrame([(u, 1, 3.0, T0) for u in range(10)], schemas.RATINGS)
    s = files.sample_id_range(r, "userId", 1, 5, 100, persist=True)
    try:
        assert s.is_cached and s.count() == 5
    finally:
        s.unpersist()
