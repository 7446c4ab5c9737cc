"""Inputs of the named queries, and the parameters they are driven with.

The reference defaults select nothing (100 votes) or everything (support 10)
on the driver's tables, so the named queries pass 40 and 25; the operator
defaults stay the reference's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.operators import prepare
from reelstats.sources import fixtures

QUERY_MIN_VOTES = 40
QUERY_MIN_MOVIE_RATINGS = 25
QUERY_MIN_USER_RATINGS = 20


def ratings(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    return fixtures.ratings(spark, sf_dir, spread)


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.movies(spark, sf_dir)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.enriched_ratings(
        ratings(spark, sf_dir, spread=True),
        movies(spark, sf_dir),
        min_movie_ratings=QUERY_MIN_MOVIE_RATINGS,
        min_user_ratings=QUERY_MIN_USER_RATINGS,
    )


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.shared_clean_ratings(ratings(spark, sf_dir, spread=True))


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings of active users: the rows of `enriched` without its joins with movies."""
    return prepare.ratings_active_users(clean(spark, sf_dir), QUERY_MIN_USER_RATINGS)


def active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(userId, user_rating_count, user_avg_rating) of the users of `active`, without a join with the ratings."""
    stats = prepare.user_rating_stats(clean(spark, sf_dir))
    return stats.where(F.col("user_rating_count") >= QUERY_MIN_USER_RATINGS)


def kept_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean movies with features and enough support (the movie catalogue), built
    exactly as inside the enrichment so that a query using both shares the plan."""
    return prepare.movie_catalogue(clean(spark, sf_dir), movies(spark, sf_dir), QUERY_MIN_MOVIE_RATINGS)
