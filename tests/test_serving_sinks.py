"""Serving look-ups and writers on hand-made rows."""

from __future__ import annotations

import contextlib
import os
import tempfile
from datetime import date, datetime

import pytest
from pyspark.sql import types as T

from reelstats import schemas
from reelstats.operators import serving
from reelstats.sinks import writers
from reelstats.sources import files
from tests.conftest import plan_text, rows

T0 = datetime(2020, 1, 1)
RECS = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def _movies(spark):
    return spark.createDataFrame(
        [(1, "One (2000)", "A|B"), (2, "Two (2001)", "A"), (3, "Three (2002)", "C")], schemas.MOVIES
    )


def test_user_rated_movies_defaults(spark):
    r = spark.createDataFrame([(1, 1, 4.0, T0), (1, 9, 2.0, T0)], schemas.RATINGS)
    out = rows(serving.user_rated_movies(r, _movies(spark)), ["movieId", "title", "genres", "rating"])
    assert out == [(1, "One (2000)", "A, B", 4.0), (9, "Inconnu", "", 2.0)]


def test_user_top_genres_threshold_order_and_unknown_movie(spark):
    data = [(1, 1, 5.0, T0), (1, 2, 4.0, T0), (1, 1, 4.0, T0), (1, 2, 3.0, T0),  # A: 4 films, B: 2
            (1, 3, 1.0, T0), (1, 3, 1.0, T0), (1, 3, 2.0, T0),                    # C: 3 films
            (1, 9, 5.0, T0), (1, 8, 5.0, T0), (1, 7, 5.0, T0)]                    # unknown -> ""
    r = spark.createDataFrame(data, schemas.RATINGS)
    out = [(x["genre"], x["nb_films"], x["rank"]) for x in
           serving.user_top_genres(r, _movies(spark), min_films=3, k=5).orderBy("rank").collect()]
    assert out == [("", 3, 1), ("A", 4, 2), ("C", 3, 3)]


def test_top_k_keeps_k_and_latest_batch(spark):
    data = [(1, m, float(m), 0) for m in range(1, 9)] + [(1, 2, 1.234, 1), (1, 3, 2.675, 1), (2, 1, 3.0, 0)]
    recs = spark.createDataFrame(data, RECS)
    out = serving.user_top_recommendations(recs, _movies(spark), k=5).orderBy("userId", "rank").collect()
    assert [(x["userId"], x["movieId"], x["score"]) for x in out] == [(1, 3, 2.68), (1, 2, 1.23), (2, 1, 3.0)]
    raw = serving.user_top_recommendations(recs, _movies(spark), k=5, latest_only=False)
    assert raw.where("userId = 1").count() == 5


def test_user_exists_and_collection_status(spark):
    r = spark.createDataFrame([(1, 1, 4.0, T0)], schemas.RATINGS)
    cands = spark.createDataFrame([(1,), (2,), (2,)], "userId int")
    assert rows(serving.user_exists(cands, r)) == [(1, True), (2, False)]
    empty = r.where("userId < 0")
    assert rows(serving.collection_status({"a": r, "b": empty})) == [("a", False), ("b", True)]


def test_first_users_semi_join(spark):
    r = spark.createDataFrame([(u, 1, 3.0, T0) for u in (5, 3, 3, 9, 1)], schemas.RATINGS)
    assert [x["userId"] for x in serving.first_user_ids(r, 2).collect()] == [1, 3]
    assert sorted(x["userId"] for x in serving.ratings_of_first_users(r, 2).collect()) == [1, 3, 3]


def test_rating_histogram_bins(spark):
    r = spark.createDataFrame([(1, 1, 0.5, T0), (1, 2, 0.9, T0), (1, 3, 5.0, T0), (1, 4, None, T0)],
                              schemas.RATINGS)
    assert rows(serving.user_rating_histogram(r), ["bin_start", "bin_end", "n"]) == [
        (0.5, 1.0, 2), (5.0, 5.5, 1)]


def test_fallback_writer_uses_second_path(spark):
    d = tempfile.mkdtemp(prefix="reelstats-test-")
    blocker = os.path.join(d, "file")
    open(blocker, "w").close()
    df = _movies(spark)
    used = writers.write_with_fallback(lambda p: writers.write_parquet(df, p, num_files=2),
                                       os.path.join(blocker, "under-a-file"), os.path.join(d, "fallback"))
    assert used.endswith("fallback")
    assert spark.read.parquet(used).count() == 3


def test_fallback_writer_does_not_repeat_a_failed_query(spark, tmp_path):
    from pyspark.sql import functions as F

    tried = []
    df = _movies(spark).withColumn("x", F.when(F.col("movieId") >= 0, F.raise_error(F.lit("broken query"))))

    def write(path):
        tried.append(path)
        return writers.write_parquet(df, path)

    with pytest.raises(Exception, match="broken query"):
        writers.write_with_fallback(write, str(tmp_path / "a"), str(tmp_path / "b"))
    assert tried == [str(tmp_path / "a")]


def test_published_seconds_do_not_depend_on_the_session_zone(spark):
    from reelstats.functions.columns import epoch_seconds

    r = spark.createDataFrame([(1, 2, 3.5, datetime(2023, 11, 5, 6, 30, 20))], schemas.RATINGS)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        found = set()
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            found.add(r.select(epoch_seconds("timestamp")).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert found == {1699165820}


def test_partitioned_write_prunes_on_read(spark):
    d = tempfile.mkdtemp(prefix="reelstats-test-")
    df = spark.createDataFrame(
        [(1, 1, 3.0, datetime(2020, m, 1), 2020, m) for m in (1, 2, 3)],
        "userId int, movieId int, rating double, timestamp timestamp_ntz, rating_year int, rating_month int",
    )
    path = writers.write_partitioned_parquet(df, os.path.join(d, "p"), ["rating_year", "rating_month"])
    assert sorted(os.listdir(os.path.join(path, "rating_year=2020"))) == [
        "rating_month=1", "rating_month=2", "rating_month=3"]
    one = files.read_partitions(spark, path, rating_year=2020, rating_month=2)
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(rating_year" in plan_text(one)


def test_documents_round_trip_keeps_types(spark):
    d = tempfile.mkdtemp(prefix="reelstats-test-")
    df = spark.createDataFrame(
        [(1, date(2020, 1, 2), 2020, None, 2)],
        "userId int, rating_date date, rating_year int, rating_month int, rating_day int",
    )
    docs = writers.as_rating_documents(df)
    path = writers.write_documents(docs, os.path.join(d, "docs"))
    back = files.read_documents(spark, path, docs.schema).collect()[0]
    assert back["rating_date"] == datetime(2020, 1, 2) and back["rating_month"] == 0


def test_sample_helpers(spark):
    r = spark.createDataFrame([(u, 1, 3.0, T0) for u in range(10)], schemas.RATINGS)
    assert files.sample_capped(r, 4).count() == 4
    assert sorted(x["userId"] for x in files.sample_id_range(r, "userId", 2, 5, 100).collect()) == [2, 3, 4, 5]
    assert files.sample_id_range(r, "userId", 2, 5, 3).count() == 3


def test_scale_conf_sizes_partitions():
    from reelstats.session import scale_conf

    conf = scale_conf(100 * 1024**4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert conf["spark.sql.adaptive.enabled"] == "true"
    small = scale_conf(10 * 1024**2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_fixed_fan_out_partitioned_write(spark):
    d = tempfile.mkdtemp(prefix="reelstats-test-")
    df = spark.createDataFrame(
        [(u, 1, 3.0, 2020, 1 + u % 2) for u in range(20)],
        "userId int, movieId int, rating double, rating_year int, rating_month int",
    )
    path = writers.write_partitioned_parquet(df, os.path.join(d, "p"), ["rating_year", "rating_month"],
                                             num_partitions=4)
    back = spark.read.parquet(path)
    assert back.count() == 20
    assert rows(back.groupBy("rating_month").count()) == [(1, 10), (2, 10)]


def test_keyed_messages_round_trip(spark):
    from reelstats.streaming import decode

    d = tempfile.mkdtemp(prefix="reelstats-test-")
    r = spark.createDataFrame([(1, 2, 3.5, datetime(2023, 11, 14, 22, 13, 20))], schemas.RATINGS)
    msgs = writers.to_messages(r, ["userId", "movieId", "rating"], key_col="userId")
    assert msgs.columns == ["key", "value"]
    writers.publish_messages(msgs, os.path.join(d, "m"), fmt="json", mode="overwrite")
    back = spark.read.schema("key string, value string").json(os.path.join(d, "m"))
    dec = decode.decode_json(back, keep=("key",)).first()
    assert (dec["key"], dec["userId"], dec["movieId"], dec["rating"]) == ("1", 1, 2, 3.5)


def test_lookups_with_hot_movie_split_equal_unsplit(spark):
    data = [(u, 1 if u % 2 else 2 + u % 3, 1.0 + u % 4, T0) for u in range(300)]
    r = spark.createDataFrame(data, schemas.RATINGS)
    from pyspark.sql import functions as F

    # movie 1 is hot and in the catalogue; then hot and absent from it
    for cat in (_movies(spark), _movies(spark).where("movieId <> 1")):
        _check_lookups(r, cat)
    with _no_small_joins(spark):
        found = serving.lookup_movies(r, _movies(spark).where("movieId <> 1"), ["title"], hot_rows=20)
        spread = found.where("movieId = 1").select(F.spark_partition_id().alias("p")).distinct().count()
        assert spread >= 4
    # one movie recommended to every user
    recs = spark.createDataFrame([(u, 1, 4.0, 0) for u in range(300)], "userId int, movieId int, rating float, batch_id long")
    split = serving.user_top_recommendations(recs, _movies(spark), hot_rows=20)
    whole = serving.user_top_recommendations(recs, _movies(spark), hot_rows=None)
    assert sorted(split.collect()) == sorted(whole.select(*split.columns).collect()) and split.count() == 300


@contextlib.contextmanager
def _no_small_joins(spark):
    """Neither broadcast joins nor merged shuffle partitions, as with large inputs."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _check_lookups(r, cat):
    for fn in (serving.user_rated_movies, serving.user_top_genres):
        assert sorted(fn(r, cat, hot_rows=20).collect()) == sorted(fn(r, cat, hot_rows=None).collect())
