"""Per-user look-ups re-aimed as queries over all users at once.

Top-k per user is `row_number() <= k` over a window keyed by user: Catalyst
adds a partial group limit before the shuffle (WindowGroupLimit), so each map
task forwards at most k rows per user and a very active user does not build
an unbounded group in one task. Look-ups of the movie catalogue split hot
movies with `joins.salted_join`, by the counts of the rows looked up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstats.functions.columns import (
    UNKNOWN_TITLE,
    genre_array,
    genre_display,
    rating_bin,
    round_half_up,
)
from reelstats.operators.joins import DEFAULT_HOT_ROWS, salted_join



def lookup_movies(ratings: DataFrame, movies: DataFrame, cols: list[str],
                  hot_rows: int | None = DEFAULT_HOT_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Left join of ratings with catalogue columns by movieId, hot movies split
    over several tasks, in the catalogue or not.

    `counts` (movieId, rating_count) holds the rows per movie of `ratings` or an
    upper bound, for every movie in them; by default they are counted here.
    """
    cat = movies.select("movieId", *cols)
    if counts is None:
        counts = ratings.groupBy("movieId").agg(F.count(F.lit(1)).alias("rating_count"))
    salt = ["userId"] if "userId" in ratings.columns else None
    return salted_join(ratings, cat, "movieId", "left", count_col="rating_count", hot_rows=hot_rows,
                       salt_cols=salt, counts=counts)


def first_user_ids(ratings: DataFrame, n: int = 20) -> DataFrame:
    """The `n` smallest distinct user ids (a top-n, planned as TakeOrderedAndProject)."""
    return ratings.select("userId").distinct().orderBy("userId").limit(n)


def ratings_of_first_users(ratings: DataFrame, n: int = 1000) -> DataFrame:
    """Rows of the `n` smallest user ids; the id list is at most `n` rows."""
    return ratings.join(first_user_ids(ratings, n), "userId", "left_semi")


def collection_status(collections: dict[str, DataFrame]) -> DataFrame:
    """(collection, is_empty) per collection; pass the cheapest frame that is
    empty exactly when the collection is."""
    parts = [
        df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty")).select(
            F.lit(name).alias("collection"), "is_empty"
        )
        for name, df in collections.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def user_exists(candidates: DataFrame, ratings: DataFrame) -> DataFrame:
    """(userId, found) for every distinct candidate id."""
    known = ratings.select("userId").distinct().withColumn("found", F.lit(True))
    return (
        candidates.select("userId").distinct()
        .join(known, "userId", "left")
        .withColumn("found", F.coalesce("found", F.lit(False)))
    )


def user_rated_movies(ratings: DataFrame, movies: DataFrame, hot_rows: int | None = DEFAULT_HOT_ROWS,
                      counts: DataFrame | None = None) -> DataFrame:
    """Each rating with the movie's title ('Inconnu' if unknown) and display genres."""
    rated = lookup_movies(ratings.select("userId", "movieId", "rating"), movies, ["title", "genres"],
                          hot_rows, counts)
    return rated.select(
        "userId",
        "movieId",
        F.coalesce("title", F.lit(UNKNOWN_TITLE)).alias("title"),
        genre_display("genres").alias("genres"),
        "rating",
    )


def user_rating_histogram(ratings: DataFrame, step: float = 0.5) -> DataFrame:
    """Ratings per user in bins of width `step`: [bin_start, bin_end)."""
    return (
        ratings.where(F.col("rating").isNotNull())
        .groupBy("userId", rating_bin("rating", step).alias("bin_start"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_end", F.col("bin_start") + F.lit(step))
    )


def top_k_per_key(df: DataFrame, key: str, order: list, k: int, rank_col: str = "rank") -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def user_top_genres(ratings: DataFrame, movies: DataFrame, min_films: int = 3, k: int = 5,
                    hot_rows: int | None = DEFAULT_HOT_ROWS, counts: DataFrame | None = None) -> DataFrame:
    """Per user, the `k` genres with the best mean rating among genres with
    at least `min_films` rated movies. A movie unknown to the catalogue counts
    for the empty genre, as the look-up default does."""
    per_genre = (
        lookup_movies(ratings.select("userId", "movieId", "rating"), movies, ["genres"], hot_rows, counts)
        .select("userId", "rating",
                F.explode(genre_array(F.coalesce("genres", F.lit("")))).alias("genre"))
        .groupBy("userId", "genre")
        .agg(F.avg("rating").alias("note_moyenne"), F.count("rating").alias("nb_films"))
        .where(F.col("nb_films") >= min_films)
    )
    return top_k_per_key(per_genre, "userId", [F.desc("note_moyenne"), F.asc("genre")], k)


def user_top_recommendations(recs: DataFrame, movies: DataFrame, k: int = 5,
                             latest_only: bool = True, hot_rows: int | None = DEFAULT_HOT_ROWS) -> DataFrame:
    """Per user, the `k` best-scored stored recommendations with title, genres and
    the score rounded to 2 decimals (HALF_UP).

    With `latest_only`, only the user's most recent batch counts. That is
    computed without a join: the top k by (batch desc, score desc) hold the
    latest batch's best k (or all of it when it has fewer), and the rows of
    older batches among them are dropped; each step is a per-user top-k with a
    map-side limit.
    """
    cols = recs.select("userId", "movieId", "rating", "batch_id")
    by_score = [F.desc("rating"), F.asc("movieId"), F.desc("batch_id")]
    if latest_only:
        top = top_k_per_key(cols, "userId", [F.desc("batch_id")] + by_score, k)
        newest = F.max("batch_id").over(Window.partitionBy("userId"))  # over at most k rows
        top = top.withColumn("_newest", newest).where(F.col("batch_id") == F.col("_newest")).drop("_newest")
    else:
        top = top_k_per_key(cols, "userId", by_score, k)
    return serve_recommendations(lookup_movies(top, movies, ["title", "genres"], hot_rows))


def serve_recommendations(ranked: DataFrame) -> DataFrame:
    """Ranked recommendations with the catalogue's title and genres, as the page shows them."""
    return ranked.select(
        "userId",
        "rank",
        "movieId",
        F.coalesce("title", F.lit(UNKNOWN_TITLE)).alias("title"),
        genre_display("genres").alias("genres"),
        round_half_up(F.col("rating").cast("double"), 2).alias("score"),
    )
