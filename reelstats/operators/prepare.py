"""Cleaning, features, minimum support and enrichment (the ETL path).

Plan shape, chosen for skew: every per-key statistic is a hash aggregate with a
map-side partial step, so a hot user or movie is pre-aggregated before its
shuffle; the statistics are then joined back by key with `salted_join`, which
splits a key holding more than `hot_rows` ratings over several tasks (the
statistics carry the exact row count per key). No window is partitioned by
user or movie, which would put a hot key's rows in a single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.functions.columns import date_parts, genre_count, present, title_year
from reelstats.operators.joins import DEFAULT_HOT_ROWS, salted_join
from reelstats.schemas import ENRICHED_COLUMNS

DEFAULT_MIN_MOVIE_RATINGS = 10
DEFAULT_MIN_USER_RATINGS = 20
RATING_LOW = 0.5
RATING_HIGH = 5.0


def with_title_year(movies: DataFrame) -> DataFrame:
    return movies.withColumn("year", title_year("title"))


def drop_missing(df: DataFrame) -> DataFrame:
    """Rows without NULL (or NaN in floating columns), same rows as `na.drop("any")`."""
    return df.where(present(df.schema.fields))


def dedup_latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest `order` tuple wins (a stated survivor).

    A `max(struct(...))` aggregate has a partial step, so duplicates collapse
    before the shuffle and a hot key costs one row per map task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def dedup_smallest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the smallest `order` tuple wins."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def clean_movies(movies: DataFrame, require_year: bool = True) -> DataFrame:
    """Drop rows with any NULL (the year too if `require_year`), one row per movie.

    Survivor of duplicated ids: smallest title, then genres.
    """
    df = with_title_year(movies) if require_year and "year" not in movies.columns else movies
    df = drop_missing(df)
    return dedup_smallest(df, ["movieId"], ["title", "genres"])


def clean_ratings(ratings: DataFrame, low: float = RATING_LOW, high: float = RATING_HIGH) -> DataFrame:
    """Drop rows with any NULL/NaN, keep one rating per (user, movie), then the range.

    Survivor: latest timestamp, then highest rating. The range filter comes
    after the dedup, as in the reference, so an out-of-range latest rating
    removes the pair.
    """
    df = drop_missing(ratings)
    df = dedup_latest(df, ["userId", "movieId"], ["timestamp", "rating"])
    return df.where(F.col("rating").between(low, high))


def movie_features(movies: DataFrame) -> DataFrame:
    """`year` from the title and `genre_count` from the genres."""
    return movies.withColumns({"year": title_year("title"), "genre_count": genre_count("genres")})


def rating_date_parts(ratings: DataFrame) -> DataFrame:
    return ratings.withColumns(date_parts("timestamp"))


def movie_rating_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movieId").agg(F.count("rating").alias("rating_count"))


def movies_min_support(movies: DataFrame, ratings: DataFrame,
                       min_ratings: int = DEFAULT_MIN_MOVIE_RATINGS) -> DataFrame:
    """Movies with at least `min_ratings` ratings, with their `rating_count`."""
    counts = movie_rating_counts(ratings).where(F.col("rating_count") >= min_ratings)
    return movies.join(counts, "movieId", "inner")


def user_rating_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("userId").agg(
        F.count("rating").alias("user_rating_count"), F.avg("rating").alias("user_avg_rating")
    )


def ratings_active_users(ratings: DataFrame, min_ratings: int = DEFAULT_MIN_USER_RATINGS,
                         keep_user_avg: bool = False, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Ratings of users with at least `min_ratings` ratings, with `user_rating_count`."""
    stats = user_rating_stats(ratings).where(F.col("user_rating_count") >= min_ratings)
    if not keep_user_avg:
        stats = stats.drop("user_avg_rating")
    return salted_join(ratings, stats, "userId", "inner", count_col="user_rating_count",
                       hot_rows=hot_rows, salt_cols=["movieId"])


def movie_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movieId").agg(
        F.avg("rating").alias("avg_rating"), F.count("rating").alias("num_ratings")
    )


def user_stats(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("userId").agg(
        F.count("rating").alias("user_total_ratings"), F.avg("rating").alias("user_avg_rating")
    )


def shared_clean_ratings(ratings: DataFrame) -> DataFrame:
    """`clean_ratings` materialized once for several consumers.

    Shuffle files are what Spark shares between consumers of one subplan, so
    without an exchange here each consumer would re-sort and re-aggregate the
    dedup output. A rebalance on the pair key is kept by the optimizer (a plain
    repartition on the same key is removed as redundant); the key is unique
    after the dedup, so it cannot skew.
    """
    return clean_ratings(ratings).hint("rebalance", "userId", "movieId")


def movie_catalogue(clean: DataFrame, movies: DataFrame,
                    min_movie_ratings: int = DEFAULT_MIN_MOVIE_RATINGS,
                    require_year: bool = True) -> DataFrame:
    """Clean movies with features and at least `min_movie_ratings` clean ratings:
    movieId, title, genres, year, genre_count, rating_count."""
    return movies_min_support(
        movie_features(clean_movies(movies, require_year=require_year)), clean, min_movie_ratings
    ).select("movieId", "title", "genres", "year", "genre_count", "rating_count")


def enriched_ratings(
    ratings: DataFrame,
    movies: DataFrame,
    min_movie_ratings: int = DEFAULT_MIN_MOVIE_RATINGS,
    min_user_ratings: int = DEFAULT_MIN_USER_RATINGS,
    require_year: bool = True,
    hot_rows: int = DEFAULT_HOT_ROWS,
) -> DataFrame:
    """Clean ratings of active users with movie attributes and per-key statistics.

    Same rows and 18 columns as the reference's chain of three left joins:
    movie support counts clean ratings (before the user filter) while
    `avg_rating`/`num_ratings` count active-user ratings. `user_total_ratings`
    equals `user_rating_count` by construction, so user statistics are one
    aggregate joined once; the two movie-keyed results are joined to each
    other first (both one row per movie) so the large side meets one join per key.
    Both joins with the large side split users or movies with more than
    `hot_rows` ratings (see `joins.salted_join`).
    """
    clean = shared_clean_ratings(ratings)

    users = user_rating_stats(clean).where(F.col("user_rating_count") >= min_user_ratings)
    active = salted_join(clean, users, "userId", "inner", count_col="user_rating_count",
                         hot_rows=hot_rows, salt_cols=["movieId"])

    kept_movies = movie_catalogue(clean, movies, min_movie_ratings, require_year)

    per_movie = movie_stats(active).join(kept_movies, "movieId", "left")

    # date parts are derived after the joins so the shuffles carry 4 columns less
    joined = salted_join(active, per_movie, "movieId", "left", count_col="num_ratings",
                         hot_rows=hot_rows, salt_cols=["userId"])
    return rating_date_parts(joined).select(
        *[
            F.col("user_rating_count").alias("user_total_ratings")
            if c == "user_total_ratings"
            else F.col(c)
            for c in ENRICHED_COLUMNS
        ]
    )
