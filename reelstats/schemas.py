"""Declared schemas of the data model (no inference on the hot path)."""

from pyspark.sql import types as T

MOVIES = T.StructType(
    [
        T.StructField("movieId", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("genres", T.StringType()),
    ]
)

RATINGS = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.TimestampNTZType()),
    ]
)

# One rating event on the stream; producers send `timestamp` as epoch seconds,
# which from_json reads into TIMESTAMP as seconds.
RATING_EVENT = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RECOMMENDATION_ROWS = T.StructType(
    [
        T.StructField("userId", T.IntegerType()),
        T.StructField("movieId", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("processing_time", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

ENRICHED_COLUMNS = (
    "userId",
    "movieId",
    "rating",
    "timestamp",
    "rating_date",
    "rating_year",
    "rating_month",
    "rating_day",
    "user_rating_count",
    "title",
    "genres",
    "year",
    "genre_count",
    "rating_count",
    "avg_rating",
    "num_ratings",
    "user_total_ratings",
    "user_avg_rating",
)
