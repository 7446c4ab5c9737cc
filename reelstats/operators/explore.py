"""Exploration queries over raw movies and ratings.

Top-k by movie pre-aggregates ratings per movie before the join, so the join
meets one row per movie instead of every rating (a hot movie no longer makes a
skewed join partition); the result equals aggregating the joined rows,
duplicate catalogue rows included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.functions.columns import activity_tier, genre_array, round_half_up, title_year

DEFAULT_MIN_VOTES = 100
TOP_K = 10


def movie_title_year(movies: DataFrame) -> DataFrame:
    return movies.select("movieId", "title", title_year("title").alias("year"))


def movies_per_year(movies: DataFrame) -> DataFrame:
    """Number of movies per title year (movies without a year left out)."""
    years = movie_title_year(movies).select("year").na.drop()
    return years.groupBy("year").agg(F.count(F.lit(1)).alias("nb_films")).orderBy("year")


def year_histogram(movies: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width histogram of title years; the last bin is closed; empty bins kept.

    The movies are read once: counted by year (a year has four digits, so at most
    10,000 rows remain), and the bins are cut from that one row of counts.
    Without any year all bins are empty and have no bounds.
    """
    per_year = movie_title_year(movies).where("year is not null").groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    whole = per_year.agg(
        F.min("year").cast("double").alias("lo"), F.max("year").cast("double").alias("hi"),
        F.collect_list(F.struct("year", "n")).alias("years"),
    )
    span = F.when(F.col("hi") > F.col("lo"), F.col("hi") - F.col("lo")).otherwise(F.lit(float(bins)))
    b = F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    binned = whole.select("lo", span.alias("span"), "years", b).select(
        "bin",
        (F.col("lo") + F.col("span") * F.col("bin") / float(bins)).alias("bin_start"),
        (F.col("lo") + F.col("span") * (F.col("bin") + 1) / float(bins)).alias("bin_end"),
        F.filter("years", lambda y: _bin_of(y["year"], bins) == F.col("bin")).alias("years"),
    )
    total = F.aggregate("years", F.lit(0).cast("long"), lambda n, y: n + y["n"])
    return binned.select("bin", "bin_start", "bin_end", total.alias("n")).orderBy("bin")


def _bin_of(year, bins: int):
    """The bin of a year, from the columns lo and span."""
    return F.least(F.floor((year - F.col("lo")) / (F.col("span") / float(bins))), F.lit(bins - 1))


def genre_counts(movies: DataFrame) -> DataFrame:
    """Movies per genre, most frequent first; a table without genres gives no rows."""
    if "genres" not in movies.columns:
        return movies.limit(0).select(
            F.lit(None).cast("string").alias("genre"), F.lit(0).cast("long").alias("count")
        )
    return (
        movies.select(F.explode(genre_array("genres")).alias("genre"))
        .groupBy("genre")
        .count()
        .orderBy(F.desc("count"), "genre")
    )


def _per_movie(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("movieId").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("rating").alias("_nr"),
        F.sum("rating").alias("_s"),
    )


def _movie_totals(ratings: DataFrame, movies: DataFrame, keys: list[str]) -> DataFrame:
    cat = movies.select(*keys)
    joined = _per_movie(ratings).join(cat, "movieId", "inner")
    nr = F.sum("_nr")
    return joined.groupBy(*keys).agg(
        F.sum("_n").alias("nb_notes"),
        F.when(nr > 0, F.sum("_s") / nr).alias("_avg"),
    )


def most_rated_movies(ratings: DataFrame, movies: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top-k movies by number of ratings, with title and genres."""
    keys = ["movieId", "title", "genres"]
    return (
        _movie_totals(ratings, movies, keys)
        .drop("_avg")
        .orderBy(F.desc("nb_notes"), *keys)
        .limit(k)
    )


def most_rated_movies_avg_rounded(ratings: DataFrame, movies: DataFrame, k: int = TOP_K) -> DataFrame:
    keys = ["movieId", "title"]
    return (
        _movie_totals(ratings, movies, keys)
        .select(*keys, "nb_notes", round_half_up("_avg", 2).alias("note_moyenne"))
        .orderBy(F.desc("nb_notes"), *keys)
        .limit(k)
    )


def most_rated_movies_avg(ratings: DataFrame, movies: DataFrame, k: int = TOP_K) -> DataFrame:
    keys = ["movieId", "title", "genres"]
    return (
        _movie_totals(ratings, movies, keys)
        .withColumnRenamed("_avg", "moyenne_notes")
        .orderBy(F.desc("nb_notes"), *keys)
        .limit(k)
    )


def best_rated_movies(ratings: DataFrame, movies: DataFrame, min_votes: int = DEFAULT_MIN_VOTES,
                      k: int = TOP_K) -> DataFrame:
    """Top-k by rounded mean among movies with at least `min_votes` ratings."""
    keys = ["movieId", "title"]
    return (
        _movie_totals(ratings, movies, keys)
        .select(*keys, "nb_notes", round_half_up("_avg", 2).alias("moyenne_note"))
        .where(F.col("nb_notes") >= min_votes)
        .orderBy(F.desc_nulls_last("moyenne_note"), F.desc("nb_notes"), *keys)
        .limit(k)
    )


def rating_distribution(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("rating").count().orderBy(F.asc_nulls_first("rating"))


def movies_with_rating(ratings: DataFrame, value: float) -> DataFrame:
    return ratings.where(F.col("rating") == value).select("movieId").distinct()


def movies_with_extreme_rating(ratings: DataFrame, low: float = 0.5, high: float = 5.0) -> DataFrame:
    """Distinct movies with at least one `low` rating, and with one `high` rating."""
    flags = ratings.where(F.col("rating").isin(low, high)).groupBy("movieId").agg(
        F.max(F.col("rating") == low).alias("has_low"),
        F.max(F.col("rating") == high).alias("has_high"),
    )
    return flags.agg(
        F.count_if("has_low").alias("n_movies_low"),
        F.count_if("has_high").alias("n_movies_high"),
    )


def user_activity_tiers(ratings: DataFrame, width: int = 100, max_ratings: int | None = None) -> DataFrame:
    """Users per bucket of `width` ratings (counting non-NULL ratings)."""
    per_user = ratings.groupBy("userId").agg(F.count("rating").alias("nb_notes"))
    if max_ratings is not None:
        per_user = per_user.where(F.col("nb_notes") <= max_ratings)
    return (
        per_user.groupBy(activity_tier("nb_notes", width).alias("palier"))
        .count()
        .orderBy("palier")
    )


def ratings_per_year(ratings: DataFrame) -> DataFrame:
    return (
        ratings.groupBy(F.year("timestamp").alias("year"))
        .agg(F.count(F.lit(1)).alias("nb_notes"))
        .orderBy(F.asc_nulls_first("year"))
    )
