"""Distributed writers. Nothing is collected to the driver.

Partitioned writes use the `rebalance` hint by default: AQE then splits a
partition value that holds a large share of the rows into several tasks and
merges small ones, instead of `repartition(n, year, month)` sending a hot
month to a single task.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark import SparkContext
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.functions.columns import json_value


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", header).csv(path)
    return path


def write_partitioned_parquet(
    df: DataFrame,
    path: str,
    partition_cols: list[str],
    num_partitions: int | None = None,
    mode: str = "overwrite",
) -> str:
    """Parquet partitioned by `partition_cols`.

    `num_partitions` reproduces a fixed `repartition(n, *cols)` fan-out; by
    default the layout is left to AQE through a rebalance on the same columns.
    """
    if num_partitions is not None:
        laid_out = df.repartition(num_partitions, *partition_cols)
    else:
        laid_out = df.hint("rebalance", *partition_cols)
    laid_out.write.mode(mode).partitionBy(*partition_cols).parquet(path)
    return path


def write_parquet(df: DataFrame, path: str, num_files: int | None = None, mode: str = "overwrite") -> str:
    """Unpartitioned Parquet; `num_files` fixes the file count (a round-robin repartition)."""
    (df.repartition(num_files) if num_files else df).write.mode(mode).parquet(path)
    return path


def _is_io_error(error: Exception) -> bool:
    """Is there an I/O error among the causes?"""
    if isinstance(error, OSError):
        return True
    origin = error if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
    cause = origin.java_exception if isinstance(origin, Py4JJavaError) else origin
    gateway = SparkContext._gateway
    while cause is not None:
        if is_instance_of(gateway, cause, "java.io.IOException"):
            return True
        cause = cause.getCause()
    return False


def write_with_fallback(write: Callable[[str], str], primary: str, fallback: str) -> str:
    """Write to `primary`; where storage refuses it, write to `fallback`. Returns the
    path used. A query that fails for another reason is not run again."""
    try:
        return write(primary)
    except (PySparkException, Py4JJavaError, OSError) as primary_error:
        if not _is_io_error(primary_error):
            raise
        try:
            return write(fallback)
        except Exception as fallback_error:
            raise fallback_error from primary_error


def as_rating_documents(df: DataFrame) -> DataFrame:
    """Document form of enriched ratings: the date becomes a midnight timestamp,
    date parts are plain integers (missing ones become 0)."""
    out = df
    if "rating_date" in df.columns:
        out = out.withColumn("rating_date", F.col("rating_date").cast("timestamp_ntz"))
    for c in ("rating_year", "rating_month", "rating_day"):
        if c in df.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("int"))
    return out


def write_documents(df: DataFrame, path: str | None = None, fmt: str = "json", mode: str = "overwrite",
                    options: dict[str, str] | None = None) -> str | None:
    """Full refresh (overwrite) or append of a document collection.

    The format is pluggable: JSON lines by default, or any installed connector
    with its own options (e.g. a document-store format with database/collection).
    """
    writer = df.write.format(fmt).mode(mode).options(**(options or {}))
    if path is None:
        writer.save()
    else:
        writer.save(path)
    return path


def to_messages(df: DataFrame, value_cols: list[str], key_col: str | None = None) -> DataFrame:
    """One JSON message per row: `value` (and `key` as text)."""
    cols = [json_value(*value_cols).alias("value")]
    if key_col is not None:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


def publish_messages(messages: DataFrame, path: str | None = None, fmt: str = "text",
                     options: dict[str, str] | None = None, mode: str = "append") -> str | None:
    """Write messages: text files holding one JSON value per line by default, or a
    message-bus format (e.g. `kafka` with `kafka.bootstrap.servers` and `topic`)."""
    data = messages.select("value") if fmt == "text" else messages
    writer = data.write.format(fmt).mode(mode).options(**(options or {}))
    if path is None:
        writer.save()
    else:
        writer.save(path)
    return path
