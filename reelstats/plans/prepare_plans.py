"""ETL-path queries: cleaning, features, support, statistics, enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelstats.operators import prepare, profile, rolling_stats
from reelstats.plans import inputs
from reelstats.plans.oracle import (
    CLEAN_MOVIES,
    CLEAN_RATINGS,
    MOVIE_FEATURES,
    enriched_ctes,
    with_fixtures,
)
from reelstats.plans.registry import register
from reelstats.schemas import ENRICHED_COLUMNS
from reelstats.session import scratch_path

MIN_MOVIE = inputs.QUERY_MIN_MOVIE_RATINGS
MIN_USER = inputs.QUERY_MIN_USER_RATINGS
ENRICHED_SQL = with_fixtures(enriched_ctes(MIN_MOVIE, MIN_USER) + " SELECT * FROM en")


def _clean_ratings(spark, sf_dir):
    return prepare.clean_ratings(inputs.ratings(spark, sf_dir, spread=True))


def _active(spark, sf_dir):
    return prepare.ratings_active_users(
        prepare.rating_date_parts(_clean_ratings(spark, sf_dir)), MIN_USER
    )


@register("clean_movies", with_fixtures(f"WITH {CLEAN_MOVIES.strip()} SELECT * FROM cm"))
def clean_movies(spark, sf_dir):
    return prepare.clean_movies(inputs.movies(spark, sf_dir), require_year=True)


@register(
    "clean_ratings",
    with_fixtures(f"WITH {CLEAN_RATINGS.strip()} SELECT userId, movieId, rating, timestamp FROM cr"),
)
def clean_ratings(spark, sf_dir):
    return _clean_ratings(spark, sf_dir)


@register(
    "movie_features",
    with_fixtures(f"WITH {CLEAN_MOVIES.strip()}, {MOVIE_FEATURES.strip()} SELECT * FROM mf"),
)
def movie_features(spark, sf_dir):
    return prepare.movie_features(prepare.clean_movies(inputs.movies(spark, sf_dir)))


@register("rating_date_parts", with_fixtures(f"WITH {CLEAN_RATINGS.strip()} SELECT * FROM cr"))
def rating_date_parts(spark, sf_dir):
    return prepare.rating_date_parts(_clean_ratings(spark, sf_dir))


@register(
    "movies_min_support",
    with_fixtures(enriched_ctes(MIN_MOVIE, MIN_USER) + " SELECT * FROM ms"),
)
def movies_min_support(spark, sf_dir):
    return inputs.kept_movies(spark, sf_dir)


@register(
    "ratings_active_users",
    with_fixtures(enriched_ctes(MIN_MOVIE, MIN_USER) + " SELECT * FROM ar"),
)
def ratings_active_users(spark, sf_dir):
    return _active(spark, sf_dir)


@register("movie_stats", with_fixtures(enriched_ctes(MIN_MOVIE, MIN_USER) + " SELECT * FROM st"))
def movie_stats(spark, sf_dir):
    return prepare.movie_stats(_active(spark, sf_dir))


@register("user_stats", with_fixtures(enriched_ctes(MIN_MOVIE, MIN_USER) + " SELECT * FROM us"))
def user_stats(spark, sf_dir):
    return prepare.user_stats(_active(spark, sf_dir))


@register(
    "movie_stats_kept_up_to_date",
    with_fixtures(
        "SELECT movieId, COUNT(*) AS num_ratings, AVG(rating) AS avg_rating FROM ("
        "SELECT *, ROW_NUMBER() OVER (PARTITION BY userId, movieId, YEAR(timestamp), MONTH(timestamp) ORDER BY timestamp DESC, rating DESC) AS rn "
        "FROM ratings WHERE rating BETWEEN 0.5e0 AND 5e0 AND userId IS NOT NULL AND movieId IS NOT NULL AND timestamp IS NOT NULL) t "
        "WHERE rn = 1 GROUP BY movieId"
    ),
)
def movie_stats_kept_up_to_date(spark, sf_dir):
    """Counts and averages per movie after three deliveries: two thirds of all ratings, the late last third,
    and a repeated part of both, folded in by month."""
    store = scratch_path(spark, "rolling-stats")
    valid = inputs.ratings(spark, sf_dir).where(F.col("rating").between(0.5, 5.0))
    late = F.pmod(F.xxhash64("userId", "movieId"), F.lit(3)) == 0
    for delivery in (valid.where(~late), valid.where(late), valid.where(F.col("userId") % 5 == 0)):
        rolling_stats.fold_in(delivery, store)
    return rolling_stats.current_stats(spark, store)


@register("enriched_ratings", ENRICHED_SQL)
def enriched_ratings(spark, sf_dir):
    return inputs.enriched(spark, sf_dir)


@register(
    "enriched_counts",
    with_fixtures(
        enriched_ctes(MIN_MOVIE, MIN_USER)
        + " SELECT COUNT(*) AS n_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT userId FROM en) u)"
        " AS n_users, (SELECT COUNT(*) FROM (SELECT DISTINCT movieId FROM en) m) AS n_movies FROM en"
    ),
)
def enriched_counts(spark, sf_dir):
    return profile.key_counts(inputs.active(spark, sf_dir))


_FLOATING = {"rating", "avg_rating", "user_avg_rating"}


@register(
    "enriched_null_profile",
    with_fixtures(
        enriched_ctes(MIN_MOVIE, MIN_USER)
        + " SELECT "
        + ", ".join(
            f"COUNT(CASE WHEN {c} IS NULL"
            + (f" OR isnan({c})" if c in _FLOATING else "")
            + f" THEN 1 END) AS {c}"
            for c in ENRICHED_COLUMNS
        )
        + " FROM en"
    ),
)
def enriched_null_profile(spark, sf_dir):
    return profile.null_nan_profile(inputs.enriched(spark, sf_dir))
