"""Plan-shape checks for the scale properties the operators rely on."""

from __future__ import annotations

import os
import tempfile

import pytest

import __spark_entry__ as entry
from reelstats.plans import inputs
from reelstats.sources import files
from tests.conftest import SMALL_SF_DIR, plan_text

STATIC_KEYS = [
    k for k in entry.oracle_sql()
    if not k.startswith(("stream_", "als_", "recommend_", "train_", "publish_", "csv_", "movies_parquet",
                         "enriched_parquet", "movies_documents", "first_users_ratings_documents"))
]


def _executed(df):
    df.collect()  # after an action the DataFrame's adaptive plan is final
    return plan_text(df)


@pytest.mark.parametrize("key", STATIC_KEYS)
def test_no_cartesian_or_nested_loop_join(spark, key):
    plan = plan_text(entry.queries()[key](spark, SMALL_SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_enriched_reuses_the_clean_ratings_shuffle(spark):
    plan = _executed(inputs.enriched(spark, SMALL_SF_DIR))
    assert "ReusedExchange" in plan
    # per-key statistics are partial aggregates, no window keyed by user or movie
    assert "partial_count" in plan and "Window" not in plan


def test_top_k_per_user_is_limited_before_the_shuffle(spark):
    plan = plan_text(entry.queries()["user_top_genres"](spark, SMALL_SF_DIR))
    assert "WindowGroupLimit" in plan


def test_scan_prunes_columns_and_pushes_filters(spark):
    d = tempfile.mkdtemp(prefix="reelstats-plan-")
    path = os.path.join(d, "ratings")
    inputs.ratings(spark, SMALL_SF_DIR).write.parquet(path)
    ratings = spark.read.parquet(path)
    sample = files.sample_id_range(ratings, "userId", 1, 1000, 2_000_000).select("movieId")
    plan = plan_text(sample)
    assert "PushedFilters: [IsNotNull(userId), GreaterThanOrEqual(userId,1), LessThanOrEqual(userId,1000)]" in plan
    assert "ReadSchema: struct<userId:int,movieId:int>" in plan
    line = plan_text(entry.queries()["most_rated_movies"](spark, SMALL_SF_DIR))
    assert "l_extendedprice" not in line and "o_totalprice" not in line



def _hot_user_fixture(spark):
    from datetime import datetime, timedelta

    from reelstats import schemas

    t0 = datetime(2020, 1, 1)
    data = [(0 if i % 3 == 0 else 1 + i % 400, i % 997, 0.5 + (i % 10) / 2, t0 + timedelta(days=i % 30))
            for i in range(30000)]
    ratings = spark.createDataFrame(data, schemas.RATINGS)
    movies = spark.createDataFrame([(m, f"m{m} (2000)", "A") for m in range(997)], schemas.MOVIES)
    return ratings, movies


def test_salted_join_splits_a_hot_key_and_keeps_rows(spark):
    from pyspark.sql import functions as F

    from reelstats.operators.joins import salted_join

    ratings, _ = _hot_user_fixture(spark)
    per_user = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"), F.avg("rating").alias("a"))
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for how in ("inner", "left"):
            salted = salted_join(ratings, per_user, "userId", how, count_col="n", hot_rows=1000)
            plain = ratings.join(per_user, "userId", how)
            assert sorted(salted.collect()) == sorted(plain.select(*salted.columns).collect())
        spread = (salted_join(ratings, per_user, "userId", "inner", count_col="n", hot_rows=1000)
                  .where("userId = 0").select(F.spark_partition_id().alias("p")).distinct().count())
        unsplit = (ratings.join(per_user, "userId").where("userId = 0")
                   .select(F.spark_partition_id().alias("p")).distinct().count())
        assert unsplit == 1 and spread >= 4
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_enrichment_with_hot_user_and_movie_split_equals_unsplit(spark):
    from reelstats.operators import prepare

    ratings, movies = _hot_user_fixture(spark)
    split = prepare.enriched_ratings(ratings, movies, min_movie_ratings=1, min_user_ratings=1, hot_rows=500)
    whole = prepare.enriched_ratings(ratings, movies, min_movie_ratings=1, min_user_ratings=1,
                                     hot_rows=10**12)
    assert split.count() == whole.count() > 0
    assert sorted(split.collect()) == sorted(whole.collect())


def test_a_single_users_look_up_prunes_the_stored_collection(spark):
    from reelstats.operators import serving
    from reelstats.session import scratch_path

    path = scratch_path(spark, "stored-ratings")
    inputs.active(spark, SMALL_SF_DIR).select("userId", "movieId", "rating").write.parquet(path)
    stored, movies = spark.read.parquet(path), inputs.movies(spark, SMALL_SF_DIR).dropDuplicates(["movieId"])
    user = stored.first()["userId"]
    # one user's rows need no split, so nothing counts the whole collection
    for whole in (serving.user_rated_movies(stored, movies, hot_rows=None), serving.user_rating_histogram(stored),
                  serving.user_top_genres(stored, movies, hot_rows=None)):
        one = whole.where(whole["userId"] == user)
        scans = [x for x in plan_text(one, "formatted").split("\n") if x.startswith("PushedFilters")]
        assert [x for x in scans if f"EqualTo(userId,{user})" in x]
        assert plan_text(one).count("ReadSchema: struct<userId:int") == 1
        assert sorted(one.collect()) == sorted(r for r in whole.collect() if r["userId"] == user)
    # split look-ups push the filter into the rows looked up as well
    split = serving.user_rated_movies(stored, movies).where(f"userId = {user}")
    assert f"EqualTo(userId,{user})" in plan_text(split, "formatted")
