"""Batch readers: CSV, documents, samples, temp views, guarded loads."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class DataLoadError(RuntimeError):
    """A source could not be loaded; carries the caller's message."""


def safe_load(loader: Callable[..., DataFrame], *args: Any, error_msg: str = "load failed",
              **kwargs: Any) -> DataFrame:
    """Run `loader`; turn any failure into a typed error instead of exiting."""
    try:
        return loader(*args, **kwargs)
    except Exception as exc:  # the loader's own error type is unknown here
        raise DataLoadError(f"{error_msg}: {exc}") from exc


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             header: bool = True, infer_schema: bool = False) -> DataFrame:
    """CSV scan with a header; a declared schema avoids the extra inference pass."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def _kept(df: DataFrame, persist: bool) -> DataFrame:
    # the caller owns the cache and calls unpersist() when done
    return df.persist(StorageLevel.MEMORY_AND_DISK) if persist else df


def _capped(df: DataFrame, cap: int | None) -> DataFrame:
    return df if cap is None else df.limit(cap)


def sample_capped(df: DataFrame, cap: int | None = None, persist: bool = False) -> DataFrame:
    """At most `cap` rows, which rows is unspecified (a limit gathers
    them in one partition); without a cap all rows, as they lie. Optionally cached."""
    return _kept(_capped(df, cap), persist)


def sample_id_range(df: DataFrame, column: str, low: int, high: int, cap: int | None = None,
                    persist: bool = False) -> DataFrame:
    """Rows whose id lies in [low, high], at most `cap` of them if given; optionally cached."""
    return _kept(_capped(df.where(F.col(column).between(low, high)), cap), persist)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def read_documents(spark: SparkSession, path: str, schema: T.StructType,
                   fmt: str = "json", options: dict[str, str] | None = None) -> DataFrame:
    """A document collection written by `sinks.write_documents`, with its schema."""
    return spark.read.format(fmt).options(**(options or {})).schema(schema).load(path)


def read_partitions(spark: SparkSession, path: str, **equals: Any) -> DataFrame:
    """Read a partitioned Parquet table restricted to partition values (e.g.
    rating_year=1996, rating_month=5); only the matching folders are listed and read."""
    df = spark.read.parquet(path)
    for name, value in equals.items():
        df = df.where(F.col(name) == value)
    return df


def find(collection: DataFrame, predicate: Column) -> DataFrame:
    """Collection scan with a predicate that the source can push down."""
    return collection.where(predicate)


def find_in(collection: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Documents whose `on` value is in `keys` (a distributed `$in`)."""
    return collection.join(keys.select(on).distinct(), on, "left_semi")
