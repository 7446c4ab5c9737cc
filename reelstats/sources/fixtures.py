"""Stand-in `ratings`, `movies` and rating-message tables over the driver's data.

The expressions are the FIXTURES.md definitions, kept as SQL text so that the
Spark plan and the DuckDB oracle evaluate the very same expressions. They are
deterministic and grow with the underlying tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.sources.tables import read_table, spread_scan

RATING_SQL = (
    "CASE WHEN l_partkey % 101 = 0 THEN CAST(NULL AS DOUBLE) "
    "WHEN (l_orderkey + l_partkey) % 211 = 0 THEN 0e0 "
    "WHEN (l_orderkey + l_partkey) % 223 = 0 THEN 5.5e0 "
    "ELSE CAST(CEIL(l_quantity / 5e0) AS DOUBLE) / 2e0 END"
)

TITLE_SQL = (
    "CASE WHEN p_partkey % 97 = 0 THEN CAST(NULL AS STRING) "
    "WHEN p_partkey % 17 = 0 THEN p_name "
    "ELSE CONCAT(p_name, ' (', CAST(1950 + p_size AS STRING), ')') END"
)

GENRES_SQL = (
    "CASE WHEN p_partkey % 5 = 0 THEN p_type "
    "WHEN p_partkey % 2 = 0 THEN CONCAT(p_type, '|', UPPER(SPLIT_PART(p_name, ' ', 2))) "
    "ELSE CONCAT(p_type, '|', UPPER(SPLIT_PART(p_name, ' ', 1)), '|', "
    "UPPER(SPLIT_PART(p_name, ' ', 2))) END"
)

# Every `error` event becomes malformed JSON; the others carry a rating event
# with the time as epoch seconds, as the producers send it.
MESSAGE_VALUE_SQL = (
    "CASE WHEN event_type = 'error' THEN 'not-json' ELSE to_json(named_struct("
    "'userId', CAST(user_id AS INT), 'movieId', CAST(event_id % 200 AS INT), "
    "'rating', 0.5e0 + (CAST(FLOOR(value) AS BIGINT) % 10) / 2e0, "
    "'timestamp', unix_timestamp(ts))) END"
)


def ratings(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """`ratings(userId int, movieId int, rating double, timestamp timestamp_ntz)`.

    spread: deal a scan of few files over all cores first, for the heavier queries.
    """
    line = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_shipdate"
    )
    line = spread_scan(line) if spread else line
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return line.join(orders, line["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
        F.expr(RATING_SQL).alias("rating"),
        F.col("l_shipdate").alias("timestamp"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`movies(movieId int, title string, genres string)` with exact duplicate rows."""
    base = read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("movieId"),
        F.expr(TITLE_SQL).alias("title"),
        F.expr(GENRES_SQL).alias("genres"),
    )
    return base.unionAll(base.where(F.col("movieId") % 53 == 0))


def rating_messages(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """`rating_messages(event_id bigint, value string)`: JSON text messages."""
    ev = events if events is not None else read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.expr(MESSAGE_VALUE_SQL).alias("value"))


def events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """The `events` table as a file stream: a folder of part files, or one file by way of its directory."""
    table = read_table(spark, sf_dir, "events")
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if all(f.rstrip("/").endswith("/events.parquet") for f in table.inputFiles()):
        return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return reader.parquet(f"{sf_dir}/events.parquet")
