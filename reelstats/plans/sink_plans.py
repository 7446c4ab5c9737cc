"""Sink queries: Parquet and document round trips, views, first users, samples.

Each writer runs on the cluster into a fresh folder under the shared root
(spark.checkpoint.dir); the returned DataFrame reads the written data back.
"""

from __future__ import annotations

from reelstats.operators import prepare, profile, serving
from reelstats.plans import inputs
from reelstats.plans.oracle import enriched_ctes, with_fixtures
from reelstats.plans.prepare_plans import MIN_MOVIE, MIN_USER
from reelstats.plans.registry import register
from reelstats.session import scratch_path
from reelstats.sinks import refresh, writers
from reelstats.sources import files

ENRICHED = enriched_ctes(MIN_MOVIE, MIN_USER)
FIRST_USERS = 1000
ENRICHED_COLUMNS = (
    "userId", "movieId", "rating", "timestamp", "rating_date", "rating_year", "rating_month", "rating_day", "user_rating_count",
    "title", "genres", "year", "genre_count", "rating_count", "avg_rating", "num_ratings", "user_total_ratings", "user_avg_rating",
)
REFERENCE_SAMPLE_CAP = 1_000_000


@register("enriched_parquet_roundtrip", with_fixtures(ENRICHED + " SELECT * FROM en"))
def enriched_parquet_roundtrip(spark, sf_dir):
    """Enriched ratings written partitioned by rating_year/rating_month, read back whole."""
    path = writers.write_partitioned_parquet(
        inputs.enriched(spark, sf_dir), scratch_path(spark, "enriched"), ["rating_year", "rating_month"]
    )
    return spark.read.parquet(path)


@register(
    "enriched_profile_on_write",
    with_fixtures(
        ENRICHED + " SELECT COUNT(*) AS n_rows, "
        + ", ".join(
            f"COUNT(*) FILTER (WHERE {c} IS NULL{f' OR isnan({c})' if c in ('rating', 'avg_rating', 'user_avg_rating') else ''}) AS {c}"
            for c in ENRICHED_COLUMNS
        )
        + " FROM en"
    ),
)
def enriched_profile_on_write(spark, sf_dir):
    """Rows and NULL or NaN values per column of the enriched ratings, counted while they are written."""
    return profile.profile_while_writing(
        inputs.enriched(spark, sf_dir),
        lambda df: writers.write_partitioned_parquet(df, scratch_path(spark, "enriched"), ["rating_year", "rating_month"]),
    )


@register("movies_parquet_roundtrip", with_fixtures(ENRICHED + " SELECT * FROM ms"))
def movies_parquet_roundtrip(spark, sf_dir):
    """Kept movies written as 50 Parquet files, with a fallback location."""
    movies = inputs.kept_movies(spark, sf_dir)
    used = writers.write_with_fallback(
        lambda p: writers.write_parquet(movies, p, num_files=50),
        scratch_path(spark, "movies"),
        scratch_path(spark, "movies-fallback"),
    )
    return spark.read.parquet(used)


@register(
    "ratings_view_sql",
    with_fixtures(
        ENRICHED + " SELECT rating_year, rating_month, COUNT(*) AS n_ratings, "
        "AVG(rating) AS avg_rating FROM en GROUP BY rating_year, rating_month"
    ),
)
def ratings_view_sql(spark, sf_dir):
    files.register_view(prepare.rating_date_parts(inputs.active(spark, sf_dir)), "ratings_view")
    return spark.sql(
        "SELECT rating_year, rating_month, COUNT(*) AS n_ratings, AVG(rating) AS avg_rating "
        "FROM ratings_view GROUP BY rating_year, rating_month"
    )


@register("movies_documents", with_fixtures(ENRICHED + " SELECT * FROM ms"))
def movies_documents(spark, sf_dir):
    """Full refresh of the movie collection (JSON documents), read back."""
    movies = inputs.kept_movies(spark, sf_dir)
    path = writers.write_documents(movies, scratch_path(spark, "movies-docs"))
    return files.read_documents(spark, path, movies.schema)


@register(
    "first_users_ratings_documents",
    with_fixtures(
        ENRICHED
        + f", fu AS (SELECT DISTINCT userId FROM en ORDER BY userId LIMIT {FIRST_USERS}) "
        "SELECT userId, movieId, rating, timestamp, CAST(rating_date AS TIMESTAMP) AS rating_date, "
        "rating_year, rating_month, rating_day, user_rating_count, title, genres, year, genre_count, "
        "rating_count, avg_rating, num_ratings, user_total_ratings, user_avg_rating "
        "FROM en WHERE userId IN (SELECT userId FROM fu)"
    ),
)
def first_users_ratings_documents(spark, sf_dir):
    """Full refresh of the rating collection with the first 1000 users' enriched ratings."""
    docs = writers.as_rating_documents(
        serving.ratings_of_first_users(inputs.enriched(spark, sf_dir), FIRST_USERS)
    )
    path = writers.write_documents(docs, scratch_path(spark, "ratings-docs"))
    return files.read_documents(spark, path, docs.schema)


@register(
    "first_user_ids",
    with_fixtures(ENRICHED + " SELECT DISTINCT userId FROM en ORDER BY userId LIMIT 20"),
)
def first_user_ids(spark, sf_dir):
    return serving.first_user_ids(inputs.active_users(spark, sf_dir), 20)


@register(
    "ratings_sample_by_id_range",
    with_fixtures("SELECT * FROM ratings WHERE userId BETWEEN 1 AND 1000"),
)
def ratings_sample_by_id_range(spark, sf_dir):
    """All ratings of users 1-1000."""
    return files.sample_id_range(inputs.ratings(spark, sf_dir), "userId", 1, 1000)


@register(
    "ratings_sample_capped",
    with_fixtures(f"SELECT LEAST(COUNT(*), {REFERENCE_SAMPLE_CAP}) AS n_rows FROM ratings"),
    check="inv",
)
def ratings_sample_capped(spark, sf_dir):
    """Row count of the capped sample: min(rows, cap)."""
    return profile.row_count(files.sample_capped(inputs.ratings(spark, sf_dir), REFERENCE_SAMPLE_CAP))



@register("movies_collection_refresh", with_fixtures(ENRICHED + " SELECT * FROM ms"))
def movies_collection_refresh(spark, sf_dir):
    """The movie collection refreshed as a whole, twice, and read back as of its last refresh."""
    path, movies = scratch_path(spark, "movie-collection"), inputs.kept_movies(spark, sf_dir)
    refresh.refresh_collection(movies.where("movieId % 2 = 0"), path)
    refresh.refresh_collection(movies, path)
    return refresh.read_collection(spark, path)
