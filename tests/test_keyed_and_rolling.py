"""Look-ups that read one bucket or nothing, and statistics folded in month by month."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstats.operators import rolling_stats
from reelstats.session import scratch_path
from reelstats.sinks import keyed
from tests.conftest import rows


def scanned(df):
    """(rows, files given to the scan's tasks, rows that the scan read) of a look-up."""
    plan = df._jdf.queryExecution().executedPlan()
    out = df.collect()
    stack, files, n = [plan], set(), 0
    while stack:
        p = stack.pop()
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            stack.append(p.executedPlan())
            continue
        if p.nodeName().startswith("Scan"):
            parts = p.inputRDD().filePartitions()
            files |= {f.filePath().toString() for i in range(parts.size()) for f in parts.apply(i).files()}
            n += p.metrics().apply("numOutputRows").value()
        children = p.children()
        stack += [children.apply(i) for i in range(children.size())]
    return out, len(files), n


@pytest.mark.parametrize("pieces", [1, 3])
def test_look_up_reads_one_bucket_and_wrong_ids_read_nothing(spark, pieces):
    rng = np.random.RandomState(1)
    # even ids only, so that odd ids lie inside every range; one user has a third of all rows
    data = [(int(2 * rng.randint(0, 2000)) if i % 3 else 8, i, float(i % 9)) for i in range(30_000)]
    df = spark.createDataFrame(data, "userId int, movieId int, rating double")
    name, path = f"keyed_{uuid.uuid4().hex}", scratch_path(spark, "keyed")
    table = keyed.write_keyed(df, name, path, "userId", buckets=8, pieces=pieces, row_group_bytes=64 << 10, page_rows=500)
    assert rows(table) == sorted(data, key=repr)
    some = data[1][0]
    found, files, n = scanned(keyed.find_key(table, "userId", some))
    assert sorted(map(tuple, found)) == sorted(r for r in data if r[0] == some)
    assert files <= pieces and n < 30_000 / 8
    found, files, n = scanned(table)
    assert 8 <= files <= 8 * pieces and n == 30_000
    for wrong in (some + 1, 1001, 2501, -5, 10**6):
        found, files, n = scanned(keyed.find_key(table, "userId", wrong))
        assert (found, n) == ([], 0) and files <= pieces  # the bucket's files are opened for their filters only
        assert not keyed.key_exists(table, "userId", wrong)
    assert keyed.key_exists(table, "userId", 8)
    hot = keyed.find_key(table, "userId", 8)
    assert hot.count() == sum(r[0] == 8 for r in data)
    assert (hot.select(F.input_file_name()).distinct().count() > 1) == (pieces > 1)  # the hot user is spread
    again = keyed.open_keyed(spark, f"{name}_b", path, df.schema, "userId", 8)
    assert rows(keyed.find_key(again, "userId", some)) == sorted((r for r in data if r[0] == some), key=repr)


def recompute(data, key):
    best = {}
    for u, m, r, t in data:
        if None not in (u, m, r, t):
            at = (u, m, t.year, t.month)
            best[at] = max(best.get(at, (datetime.min, 0.0)), (t, r))
    sums: dict = {}
    for (u, m, *_), (_, r) in best.items():
        n, total = sums.get((u, m)[key], (0, 0.0))
        sums[(u, m)[key]] = (n + 1, total + r)
    return sorted((k, n, total / n) for k, (n, total) in sums.items())


@pytest.mark.parametrize("key", ["userId", "movieId"])
def test_folds_equal_a_recompute_and_touch_only_their_months(spark, key):
    schema = "userId int, movieId int, rating double, timestamp timestamp_ntz"
    t0 = datetime(2019, 11, 20)
    first = [(i % 40, i % 23, 0.5 + i % 10 / 2, t0 + timedelta(days=i % 90)) for i in range(900)] + [(None, 1, 1.0, t0), (1, 1, None, t0), (1, 2, 3.0, None)]
    late = [(i % 40, i % 23, 5.0, t0 + timedelta(days=3, hours=i)) for i in range(50)]  # into the first month, some replace
    store = scratch_path(spark, "rolling")
    assert rolling_stats.fold_in(spark.createDataFrame(first, schema), store, key) == [201911, 201912, 202001, 202002]
    i = 0 if key == "userId" else 1
    got = lambda: sorted(tuple(r) for r in rolling_stats.current_stats(spark, store, key).collect())
    assert got() == recompute(first, i)
    files = lambda: {r[0] for x in ("ratings", "partials") for r in spark.read.parquet(f"{store}/{x}").select(F.input_file_name()).distinct().collect()}
    before = files()
    assert rolling_stats.fold_in(spark.createDataFrame(late, schema), store, key) == [201911]
    assert got() == recompute(first + late, i)
    same = {f for f in before if "rating_year=2019/rating_month=11" not in f}
    assert same and same <= files()
    # the same ratings again, and old ones: nothing changes
    rolling_stats.fold_in(spark.createDataFrame(late + first, schema), store, key)
    assert got() == recompute(first + late, i)
    assert rolling_stats.fold_in(spark.createDataFrame([], schema), store, key) == []
    one = rolling_stats.current_stats(spark, store, key, [202001])
    assert sorted(tuple(r) for r in one.collect()) == recompute([r for r in first if r[3] and (r[3].year, r[3].month) == (2020, 1)], i)


def test_a_fold_reads_the_stored_ratings_of_its_months_only(spark):
    schema = "userId int, movieId int, rating double, timestamp timestamp_ntz"
    store = scratch_path(spark, "rolling-plan")
    rolling_stats.fold_in(spark.createDataFrame([(1, m, 1.0, datetime(2020, m, 1)) for m in range(1, 13)], schema), store)
    read = rolling_stats._stored_months(spark, f"{store}/ratings", [202003], f"{schema}, rating_year int, rating_month int")
    found, files, n = scanned(read)
    assert (len(found), files, n) == (1, 1, 1)


def test_a_fold_writes_no_second_copy_of_the_merged_ratings(spark, monkeypatch):
    made = []
    real = rolling_stats.scratch_path
    monkeypatch.setattr(rolling_stats, "scratch_path", lambda s, name: made.append(name) or real(s, name))
    store = real(spark, "one-copy")
    ratings = spark.createDataFrame([(1, 2, 3.0, datetime(2020, 1, 2)), (1, 2, 4.0, datetime(2020, 1, 3)), (5, 2, 1.0, datetime(2020, 2, 1))], "userId int, movieId int, rating double, timestamp timestamp_ntz")
    for _ in range(2):
        rolling_stats.fold_in(ratings, store)
    assert made == ["new-ratings"] * 2
    assert [tuple(r) for r in rolling_stats.current_stats(spark, store).collect()] == [(2, 2, 2.5)]
