"""Message table source (offsets, cap, restart), safe refresh, counts taken while writing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reelstats.operators import profile
from reelstats.session import scratch_path
from reelstats.sinks import refresh
from reelstats.sources import message_log
from reelstats.streaming import decode, runner
from tests.conftest import rows


def messages(spark, a, b):
    return spark.range(a, b).select(F.col("id").cast("string").alias("key"), F.concat(F.lit("v"), "id").alias("value"), "id")


def collected(seen):
    return lambda batch, i: seen.append((i, sorted(r["offset"] for r in batch.collect())))


def test_batches_have_exactly_the_cap_and_go_on_after_a_restart(spark):
    out = scratch_path(spark, "log-test")
    assert message_log.append_messages(messages(spark, 0, 2500), f"{out}/log", [F.desc("id")], 3) == (0, 2500)
    seen: list = []

    def run():
        stream = message_log.read_messages(spark, f"{out}/log", f"{out}/ck", "earliest", 700)
        return runner.start_foreach_batch(stream, collected(seen), f"{out}/ck", trigger={"processingTime": "0 seconds"})

    q = run()
    while len(seen) < 2:
        q.awaitTermination(1)
    runner.stop(q)
    runner.catch_up(run())
    assert [(len(o), o[0], o[-1]) for _, o in seen] == [(700, 0, 699), (700, 700, 1399), (700, 1400, 2099), (400, 2100, 2499)]
    assert message_log.append_messages(messages(spark, 0, 100), f"{out}/log", [F.asc("id")]) == (2500, 2600)
    runner.catch_up(run())
    assert seen[-1] == (4, list(range(2500, 2600)))
    assert sorted(x for _, o in seen for x in o) == list(range(2600))
    values = spark.read.parquet(f"{out}/log/segment-00000000000000000000-*")
    assert values.where("key <> 2499 - offset OR value <> concat('v', key)").isEmpty() and values.count() == 2500


def test_a_trigger_takes_several_whole_batches(spark):
    out = scratch_path(spark, "log-batches")
    message_log.append_messages(messages(spark, 0, 2500), f"{out}/log", [F.asc("id")], 3)
    seen: list = []

    def handle(batch, i):
        found = batch.groupBy(message_log.batch_number(700).alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"))
        seen.append((i, sorted((r["b"], r["n"], r["lo"]) for r in found.collect())))

    stream = message_log.read_messages(spark, f"{out}/log", f"{out}/ck", "earliest", 700, batches_per_trigger=3, rows_per_task=500)
    runner.catch_up(runner.start_foreach_batch(stream, handle, f"{out}/ck", trigger={"processingTime": "0 seconds"}))
    assert seen == [(0, [(0, 700, 0), (1, 700, 700), (2, 700, 1400)]), (1, [(3, 400, 2100)])]


@pytest.mark.parametrize("start, want", [("latest", [30, 49]), ("10", [10, 49])])
def test_starting_offsets(spark, start, want):
    out = scratch_path(spark, "log-start")
    message_log.append_messages(messages(spark, 0, 30), f"{out}/log", [F.asc("id")])
    seen: list = []
    for cap in (None, 1000):
        stream = message_log.read_messages(spark, f"{out}/log", f"{out}/ck{cap}", start, cap)
        q = runner.start_foreach_batch(stream, collected(seen), f"{out}/ck{cap}", trigger={"processingTime": "0 seconds"})
        q.processAllAvailable()
        if message_log.end_offset(f"{out}/log") == 30:
            message_log.append_messages(messages(spark, 0, 20), f"{out}/log", [F.asc("id")])
        runner.catch_up(q)
        if start == "latest" and cap is None:
            assert [x for _, o in seen for x in o] == list(range(30, 50))
            return
    assert [x for _, o in seen for x in o] == 2 * list(range(want[0], want[1] + 1))


def test_a_cap_needs_a_position_file():
    with pytest.raises(ValueError, match="positionFile"):
        message_log.MessageLogReader({"path": "/nowhere", "maxOffsetsPerTrigger": "5"})


def test_empty_append(spark):
    out = scratch_path(spark, "log-empty")
    assert message_log.append_messages(messages(spark, 0, 0), out, [F.asc("id")]) == (0, 0)
    assert message_log.manifests(out) == []


def test_a_failed_refresh_leaves_the_old_collection(spark):
    path = scratch_path(spark, "collection-test")
    old = spark.range(0, 1000, 1, 4).select("id", F.lit("old").alias("x"))
    assert refresh.refresh_collection(old, path)["rows"] == 1000
    # most tasks finish and write their files, one row of the last fails
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 999, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id")).alias("id"), F.lit("new").alias("x"))
    with pytest.raises(Exception, match="broken row"):
        refresh.refresh_collection(broken, path)
    assert rows(refresh.read_collection(spark, path)) == rows(old)
    first = refresh.manifest(path)["files"][0].split("/")[0]
    before = refresh.read_collection(spark, path)
    new = spark.range(5).select("id", F.lit("new").alias("x"))
    refresh.refresh_collection(new, path)
    assert rows(refresh.read_collection(spark, path)) == rows(new)
    assert rows(before) == rows(old)  # a reader that began before the swap still has its files
    assert first in refresh.vacuum(path)  # and whatever tasks of the failed refresh wrote after its abort
    assert rows(refresh.read_collection(spark, path)) == rows(new)
    refresh.refresh_collection(new, path, mode="append")
    assert refresh.manifest(path)["rows"] == 10 and refresh.read_collection(spark, path).count() == 10
    refresh.refresh_collection(new.limit(0), path)
    empty = refresh.read_collection(spark, path)
    assert empty.columns == ["id", "x"] and empty.count() == 0
    with pytest.raises(FileNotFoundError):
        refresh.read_collection(spark, path + "-none")


def test_profile_comes_from_the_write(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, "b", float("nan")), (None, None, None)], "a int, b string, c double")
    path = scratch_path(spark, "profiled")
    out = profile.profile_while_writing(df, lambda d: d.write.parquet(path)).first()
    assert out.asDict() == {"n_rows": 3, "a": 1, "b": 2, "c": 2}
    assert rows(spark.read.parquet(path).where("c = 1")) == [(1, None, 1.0)]
    assert profile.profile_while_writing(df.repartition(3).where("a > 0"), lambda d: d.write.parquet(path + "2")).first()["n_rows"] == 2


def test_malformed_messages_are_counted_over_all_batches(spark):
    out = scratch_path(spark, "malformed")
    good = '{"userId":1,"movieId":2,"rating":3.0,"timestamp":1700000000}'
    for i in range(3):
        spark.createDataFrame([(good,), ("not-json",), (None,), ('{"userId":5}',)][: i + 2], "value string").coalesce(1).write.mode("append").parquet(f"{out}/in")
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    with runner.progress_totals(spark) as log:
        q = runner.start_sink(decode.valid_events(decode.counted(decode.decode_json(stream))), "noop", checkpoint=f"{out}/ck", trigger={"availableNow": True})
        runner.drain(q)
        assert log.totals(q)["input_rows"] == 9
        assert log.observed(q, decode.MESSAGE_COUNTS) == {"n_messages": 9, "n_malformed": 5}
        assert log.observed(q, "other") == {}
