"""Cleaning, features, support and enrichment on hand-made rows."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from reelstats import schemas
from reelstats.operators import prepare
from tests.conftest import rows

T0 = datetime(2020, 1, 1)


def ratings_df(spark, data):
    return spark.createDataFrame(data, schemas.RATINGS)


def movies_df(spark, data):
    return spark.createDataFrame(data, schemas.MOVIES)


def test_clean_ratings_survivor_nulls_and_range(spark):
    data = [
        (1, 10, 3.0, T0),  # older duplicate: loses to the later one
        (1, 10, 4.0, T0 + timedelta(days=1)),
        (1, 11, 2.0, T0),  # equal timestamps: the higher rating wins
        (1, 11, 4.5, T0),
        (1, 12, 4.0, T0),  # latest is out of range: the pair is removed
        (1, 12, 5.5, T0 + timedelta(days=1)),
        (2, 10, 0.0, T0),  # below range
        (2, 11, 0.5, T0),  # bounds kept
        (2, 12, 5.0, T0),
        (2, 13, None, T0),  # NULL and NaN dropped before the dedup
        (2, 14, float("nan"), T0),
        (2, 15, 3.0, None),
        (None, 16, 3.0, T0),
    ]
    out = rows(prepare.clean_ratings(ratings_df(spark, data)), ["userId", "movieId", "rating"])
    assert out == sorted(
        [(1, 10, 4.0), (1, 11, 4.5), (2, 11, 0.5), (2, 12, 5.0)], key=repr
    )


def test_nan_latest_rating_does_not_hide_older_valid_one(spark):
    # na.drop semantics: the NaN row is gone before the dedup, so the older valid rating survives
    data = [(1, 10, 3.0, T0), (1, 10, float("nan"), T0 + timedelta(days=1))]
    out = rows(prepare.clean_ratings(ratings_df(spark, data)), ["userId", "movieId", "rating"])
    assert out == [(1, 10, 3.0)]


def test_title_year_and_clean_movies(spark):
    data = [
        (1, "Heat (1995)", "A"),
        (2, "Untitled", "A|B|C"),
        (3, "Odd (95)", "A"),
        (4, "Two (1999) (2001)", ""),
        (5, None, "A"),
        (6, "Zed (1990)", "B"),  # duplicated id: the smallest title wins
        (6, "Alpha (1990)", "C"),
        (7, "Gone (2000)", None),
    ]
    movies = movies_df(spark, data)
    out = rows(prepare.clean_movies(movies), ["movieId", "title", "year"])
    assert out == sorted(
        [(1, "Heat (1995)", 1995), (4, "Two (1999) (2001)", 1999), (6, "Alpha (1990)", 1990)], key=repr
    )
    # without the year requirement, titles without a year stay
    kept = {r["movieId"] for r in prepare.clean_movies(movies, require_year=False).collect()}
    assert kept == {1, 2, 3, 4, 6}


def test_movie_features_genre_count(spark):
    data = [(1, "a (2000)", "A"), (2, "b (2000)", "A|B|C"), (3, "c (2000)", ""), (4, "d", None)]
    out = {r["movieId"]: (r["year"], r["genre_count"]) for r in prepare.movie_features(movies_df(spark, data)).collect()}
    assert out == {1: (2000, 1), 2: (2000, 3), 3: (2000, 1), 4: (None, None)}


def test_support_thresholds_are_inclusive(spark):
    data = []
    for user, n in ((1, 19), (2, 20), (3, 21)):
        data += [(user, 100 + i, 3.0, T0) for i in range(n)]
    r = ratings_df(spark, data)
    active = prepare.ratings_active_users(r, 20)
    assert {x["userId"] for x in active.collect()} == {2, 3}
    assert {x["user_rating_count"] for x in active.where("userId = 2").collect()} == {20}

    data = []
    for movie, n in ((1, 9), (2, 10), (3, 11)):
        data += [(200 + i, movie, 3.0, T0) for i in range(n)]
    movies = movies_df(spark, [(1, "a (2000)", "A"), (2, "b (2000)", "A"), (3, "c (2000)", "A")])
    kept = prepare.movies_min_support(movies, ratings_df(spark, data), 10)
    assert rows(kept, ["movieId", "rating_count"]) == [(2, 10), (3, 11)]


# --- brute force on a skewed fixture -------------------------------------------------------

def _skewed_fixture(seed=7, n=3000):
    rng = np.random.default_rng(seed)
    users = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 15, n))  # user 0: a third of the rows
    movies = np.where(rng.random(n) < 1 / 3, 0, rng.integers(1, 40, n))  # movie 0: a third too
    vals = rng.choice([0.0, 0.5, 1.0, 2.5, 3.0, 4.5, 5.0, 5.5, np.nan], n)
    days = rng.integers(0, 50, n)
    r = pd.DataFrame({"userId": users, "movieId": movies, "rating": vals,
                      "timestamp": [T0 + timedelta(days=int(d)) for d in days]})
    titles = [f"M{i} ({1950 + i})" if i % 7 else f"M{i}" for i in range(40)]
    m = pd.DataFrame({"movieId": range(40), "title": titles,
                      "genres": ["A|B" if i % 2 else "C" for i in range(40)]})
    m = pd.concat([m, m[m.movieId % 5 == 0]])  # exact duplicate rows
    return r, m


def _brute_enriched(r, m, min_movie, min_user):
    r = r.dropna()
    r = r.sort_values(["timestamp", "rating"], ascending=False).drop_duplicates(["userId", "movieId"])
    r = r[(r.rating >= 0.5) & (r.rating <= 5.0)]
    mv = m.dropna().copy()
    mv["year"] = mv.title.str.extract(r"\((\d{4})\)")[0].astype(float)
    mv = mv.dropna().sort_values(["title", "genres"]).drop_duplicates(["movieId"])
    mv["genre_count"] = mv.genres.str.split("|").str.len()
    mc = r.groupby("movieId").rating.count().rename("rating_count").reset_index()
    ms = mv.merge(mc, on="movieId")
    ms = ms[ms.rating_count >= min_movie]
    uc = r.groupby("userId").rating.count().rename("user_rating_count").reset_index()
    ar = r.merge(uc, on="userId")
    ar = ar[ar.user_rating_count >= min_user]
    st = ar.groupby("movieId").rating.agg(["mean", "count"]).reset_index()
    us = ar.groupby("userId").rating.agg(["mean"]).reset_index()
    out = ar.merge(ms, on="movieId", how="left").merge(st, on="movieId", how="left").merge(us, on="userId")
    return sorted(
        (int(x.userId), int(x.movieId), float(x.rating), None if pd.isna(x.title) else x.title,
         None if pd.isna(x.rating_count) else int(x.rating_count), round(float(x["mean_x"]), 9),
         int(x["count"]), int(x.user_rating_count), round(float(x["mean_y"]), 9))
        for _, x in out.iterrows()
    )


def test_enriched_matches_brute_force_on_skewed_data(spark):
    r, m = _skewed_fixture()
    sr = spark.createDataFrame(
        [(int(a), int(b), None if math.isnan(c) else float(c), d.to_pydatetime())
         for a, b, c, d in r.itertuples(index=False)],
        schemas.RATINGS,
    )
    sm = spark.createDataFrame([tuple(x) for x in m.itertuples(index=False)], schemas.MOVIES)
    out = prepare.enriched_ratings(sr, sm, min_movie_ratings=8, min_user_ratings=20)
    assert out.columns == list(schemas.ENRICHED_COLUMNS)
    got = sorted(
        (x.userId, x.movieId, x.rating, x.title, x.rating_count, round(x.avg_rating, 9), x.num_ratings,
         x.user_total_ratings, round(x.user_avg_rating, 9))
        for x in out.collect()
    )
    want = _brute_enriched(r.assign(rating=r.rating.astype(float)), m, 8, 20)
    assert got == want
    assert len(got) > 300
    assert any(x[3] is None for x in got) and any(x[3] is not None for x in got)
    # invariants of the reference's order of operations
    for x in out.collect():
        assert x.user_total_ratings == x.user_rating_count
        assert x.rating_count is None or x.num_ratings <= x.rating_count
        assert 0.5 <= x.rating <= 5.0


@pytest.mark.parametrize("require_year", [True, False])
def test_enriched_keeps_ratings_of_dropped_movies(spark, require_year):
    data = [(u, 1, 4.0, T0) for u in range(3)] + [(u, 2, 3.0, T0) for u in range(3)]
    movies = movies_df(spark, [(1, "Kept (2001)", "A"), (2, "No year", "B")])
    out = prepare.enriched_ratings(ratings_df(spark, data), movies, min_movie_ratings=1, min_user_ratings=1,
                                   require_year=require_year)
    titles = {x["movieId"]: x["title"] for x in out.collect()}
    assert titles[1] == "Kept (2001)"
    assert titles[2] == (None if require_year else "No year")
