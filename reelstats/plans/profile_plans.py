"""Profiling queries (shape, preview, describe, NULL counts, CSV round trip)."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelstats import schemas
from reelstats.operators import profile
from reelstats.plans import inputs
from reelstats.plans.oracle import with_fixtures
from reelstats.plans.registry import register
from reelstats.session import scratch_path
from reelstats.sinks.writers import write_csv
from reelstats.sources.files import read_csv


@register("csv_row_count", with_fixtures("SELECT COUNT(*) AS n_rows FROM ratings"))
def csv_row_count(spark, sf_dir):
    """Ratings written as CSV with a header, read back with the declared schema
    (no inference pass), counted."""
    path = write_csv(inputs.ratings(spark, sf_dir), scratch_path(spark, "ratings-csv"))
    return profile.row_count(read_csv(spark, path, schema=schemas.RATINGS))


@register(
    "table_shape",
    with_fixtures(
        "SELECT 'movies' AS table_name, 3 AS n_columns, COUNT(*) AS n_rows FROM movies "
        "UNION ALL SELECT 'ratings', 4, COUNT(*) FROM ratings"
    ),
)
def table_shape(spark, sf_dir):
    return profile.table_shape(
        {"movies": inputs.movies(spark, sf_dir), "ratings": inputs.ratings(spark, sf_dir)}
    )


@register(
    "table_preview_movies",
    with_fixtures(
        "SELECT * FROM movies ORDER BY movieId, title NULLS FIRST, genres NULLS FIRST LIMIT 5"
    ),
)
def table_preview_movies(spark, sf_dir):
    return profile.preview(inputs.movies(spark, sf_dir), 5, ["movieId", "title", "genres"])


@register(
    "table_preview_ratings",
    with_fixtures(
        "SELECT * FROM ratings ORDER BY userId, movieId, timestamp, rating NULLS FIRST LIMIT 5"
    ),
)
def table_preview_ratings(spark, sf_dir):
    return profile.preview(
        inputs.ratings(spark, sf_dir), 5, ["userId", "movieId", "timestamp", "rating"]
    )


def _describe_sql(table: str, numeric: list[str], text: list[str]) -> str:
    parts = []
    for c in numeric:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, COUNT({c}) AS n, AVG({x}) AS mean, "
            f"ROUND(STDDEV_SAMP({x}), 6) AS stddev, MIN({x}) AS min_num, MAX({x}) AS max_num, "
            f"CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM {table}"
        )
    for c in text:
        parts.append(
            f"SELECT '{c}', COUNT({c}), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), "
            f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), MIN({c}), MAX({c}) FROM {table}"
        )
    return with_fixtures(" UNION ALL ".join(parts))


def _rounded_describe(df):
    # sample stddev is summed in a different order by each engine: compare at 1e-6
    return profile.describe_typed(df).withColumn("stddev", F.round("stddev", 6))


@register("describe_movies", _describe_sql("movies", ["movieId"], ["title", "genres"]))
def describe_movies(spark, sf_dir):
    return _rounded_describe(inputs.movies(spark, sf_dir))


@register("describe_ratings", _describe_sql("ratings", ["userId", "movieId", "rating"], []))
def describe_ratings(spark, sf_dir):
    return _rounded_describe(inputs.ratings(spark, sf_dir))


def _null_sql(table: str, cols: list[str]) -> str:
    sums = ", ".join(
        f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in cols
    )
    return with_fixtures(f"SELECT {sums} FROM {table}")


@register("null_counts_movies", _null_sql("movies", ["movieId", "title", "genres"]))
def null_counts_movies(spark, sf_dir):
    return profile.null_counts(inputs.movies(spark, sf_dir))


@register(
    "null_counts_ratings", _null_sql("ratings", ["userId", "movieId", "rating", "timestamp"])
)
def null_counts_ratings(spark, sf_dir):
    return profile.null_counts(inputs.ratings(spark, sf_dir))
