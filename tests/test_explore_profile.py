"""Exploration and profiling operators on hand-made rows."""

from __future__ import annotations

import math
from datetime import datetime

import pandas as pd

from reelstats import schemas
from reelstats.operators import explore, profile
from tests.conftest import plan_text, rows

T0 = datetime(2020, 1, 1)


def test_genre_counts_split_on_pipe(spark):
    m = spark.createDataFrame([(1, "a", "A"), (2, "b", "A|B|C"), (3, "c", ""), (4, "d", None)], schemas.MOVIES)
    assert rows(explore.genre_counts(m)) == sorted([("A", 2), ("B", 1), ("C", 1), ("", 1)], key=repr)


def test_year_histogram_closed_last_bin_and_empty_bins(spark):
    years = [1950, 1951, 1975, 2000, 2000]
    m = spark.createDataFrame([(i, f"t ({y})", "A") for i, y in enumerate(years)] + [(9, "none", "A")],
                              schemas.MOVIES)
    h = explore.year_histogram(m, bins=30).collect()
    assert len(h) == 30
    assert sum(r["n"] for r in h) == len(years)
    assert h[0]["n"] == 2 and h[29]["n"] == 2  # 2000 falls in the last, closed bin
    assert h[0]["bin_start"] == 1950.0 and h[29]["bin_end"] == 2000.0
    assert sum(1 for r in h if r["n"] == 0) == 27
    some = spark.range(3).selectExpr("id as movieId", "concat('x (', 1990 + id, ')') as title", "'A' as genres")
    assert plan_text(explore.year_histogram(some)).count("Range (") == 1  # read once
    same = explore.year_histogram(m.where("title like '%2000%'"), bins=4).collect()
    assert [(r["bin_start"], r["bin_end"], r["n"]) for r in same] == [(2000.0, 2001.0, 2), (2001.0, 2002.0, 0), (2002.0, 2003.0, 0), (2003.0, 2004.0, 0)]
    without = explore.year_histogram(m.where("movieId = 9"), bins=4).collect()
    assert [tuple(r) for r in without] == [(b, None, None, 0) for b in range(4)]


def test_top_k_pre_aggregation_equals_join_then_group(spark):
    ratings = [(u, mv, float(u % 5) + 0.5, T0) for u in range(40) for mv in range(6) if (u + mv) % 3]
    ratings += [(99, 1, None, T0)]
    movies = [(mv, f"m{mv}", "A") for mv in range(6)] + [(1, "m1", "A")]  # duplicate catalogue row
    r = spark.createDataFrame(ratings, schemas.RATINGS)
    m = spark.createDataFrame(movies, schemas.MOVIES)
    got = rows(explore.most_rated_movies_avg(r, m, k=10), ["movieId", "nb_notes", "moyenne_notes"])
    pr = pd.DataFrame(ratings, columns=["userId", "movieId", "rating", "ts"])
    pm = pd.DataFrame(movies, columns=["movieId", "title", "genres"])
    j = pr.merge(pm, on="movieId")
    want = j.groupby(["movieId", "title", "genres"]).agg(nb=("userId", "size"), avg=("rating", "mean")).reset_index()
    want = sorted(((int(x.movieId), int(x.nb), float(x.avg)) for x in want.itertuples()), key=repr)
    assert [(a, b, round(c, 9)) for a, b, c in got] == [(a, b, round(c, 9)) for a, b, c in want]


def test_best_rated_movies_vote_threshold(spark):
    data = []
    for mv, n in ((1, 99), (2, 100), (3, 101)):
        data += [(u, mv, 4.0 if mv == 1 else 3.0, T0) for u in range(n)]
    r = spark.createDataFrame(data, schemas.RATINGS)
    m = spark.createDataFrame([(1, "a", "A"), (2, "b", "A"), (3, "c", "A")], schemas.MOVIES)
    out = explore.best_rated_movies(r, m, min_votes=100)
    assert [x["movieId"] for x in out.collect()] == [3, 2]  # same mean: more votes first


def test_round_is_half_up_on_the_decimal_form(spark):
    # 109 / 40 = 2.725 is stored just below 2.725; HALF_UP on the decimal form gives 2.73
    data = [(u, 1, v, T0) for u, v in enumerate([3.0] * 35 + [0.5] * 3 + [1.5, 1.0])]
    total = sum(v for _, _, v, _ in data)
    r = spark.createDataFrame(data, schemas.RATINGS)
    m = spark.createDataFrame([(1, "a", "A")], schemas.MOVIES)
    out = explore.most_rated_movies_avg_rounded(r, m).collect()[0]
    from decimal import ROUND_HALF_UP, Decimal

    want = float(Decimal(repr(total / len(data))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    assert out["note_moyenne"] == want


def test_activity_tier_boundaries(spark):
    data = []
    for user, n in enumerate([19, 20, 99, 100, 2000, 2001]):
        data += [(user, i, 3.0, T0) for i in range(n)]
    data += [(50, 1, None, T0)]  # a user whose only rating is NULL counts 0
    r = spark.createDataFrame(data, schemas.RATINGS)
    assert rows(explore.user_activity_tiers(r, 100)) == [(0, 4), (100, 1), (2000, 2)]
    tiers20 = dict(rows(explore.user_activity_tiers(r, 20, max_ratings=2000)))
    assert tiers20 == {0: 2, 20: 1, 80: 1, 100: 1, 2000: 1}


def test_extreme_ratings_and_distinct_counts(spark):
    data = [(1, 1, 0.5, T0), (2, 1, 0.5, T0), (1, 2, 5.0, T0), (1, 3, 4.0, T0), (1, None, 5.0, T0)]
    r = spark.createDataFrame(data, schemas.RATINGS)
    assert rows(explore.movies_with_extreme_rating(r)) == [(1, 2)]  # NULL id counted as a value
    assert rows(profile.distinct_count(r, "movieId")) == [(4,)]
    assert rows(profile.key_counts(r)) == [(5, 2, 4)]


def test_describe_typed_matches_pandas(spark):
    data = [(1, 10, 1.0, T0), (2, 10, 2.5, T0), (3, 20, None, T0), (4, 30, 4.0, None)]
    r = spark.createDataFrame(data, schemas.RATINGS)
    d = {x["column_name"]: x for x in profile.describe_typed(r).collect()}
    assert set(d) == {"userId", "movieId", "rating"}  # timestamps left out
    s = pd.Series([1.0, 2.5, 4.0])
    assert d["rating"]["n"] == 3
    assert math.isclose(d["rating"]["mean"], s.mean()) and math.isclose(d["rating"]["stddev"], s.std())
    assert (d["rating"]["min_num"], d["rating"]["max_num"]) == (1.0, 4.0)
    m = spark.createDataFrame([(1, "b", "x"), (2, "a", None)], schemas.MOVIES)
    t = {x["column_name"]: x for x in profile.describe_typed(m).collect()}
    assert (t["title"]["min_text"], t["title"]["max_text"], t["genres"]["n"]) == ("a", "b", 1)


def test_null_and_nan_profiles(spark):
    data = [(1, 1, float("nan"), T0), (None, 1, None, None), (3, None, 2.0, T0)]
    r = spark.createDataFrame(data, schemas.RATINGS)
    assert rows(profile.null_counts(r)) == [(1, 1, 1, 1)]
    assert rows(profile.null_nan_profile(r)) == [(1, 1, 2, 1)]  # NaN counted for the double only


def test_table_shape_and_preview(spark):
    r = spark.createDataFrame([(2, 1, 1.0, T0), (1, 1, 2.0, T0)], schemas.RATINGS)
    m = spark.createDataFrame([(1, "a", "A")], schemas.MOVIES)
    assert rows(profile.table_shape({"r": r, "m": m})) == [("m", 3, 1), ("r", 4, 2)]
    assert [x["userId"] for x in profile.preview(r, 1, ["userId"]).collect()] == [1]


def test_csv_round_trip_with_schema_and_inference(spark):
    import tempfile

    from reelstats.sinks.writers import write_csv
    from reelstats.sources.files import read_csv

    r = spark.createDataFrame([(1, 2, 3.5, T0), (2, 3, None, T0)], schemas.RATINGS)
    path = write_csv(r, tempfile.mkdtemp(prefix="reelstats-csv-") + "/r")
    typed = read_csv(spark, path, schema=schemas.RATINGS)
    assert rows(typed) == rows(r)
    inferred = read_csv(spark, path, infer_schema=True)
    assert dict(inferred.dtypes)["userId"] == "int" and inferred.count() == 2
