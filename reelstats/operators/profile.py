"""Profiling: shape, preview, typed summary statistics, NULL and NaN counts.

Each profile is a single aggregate pass over the table (one partial + final
hash aggregate), whatever the number of columns.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstats.functions.columns import is_missing

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def table_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_columns, n_rows) per table; the column count is schema metadata."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).alias("n_columns"),
            "n_rows",
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def preview(df: DataFrame, n: int = 5, order_by: list[str] | None = None) -> DataFrame:
    """First `n` rows in a stated order (all columns when no order is given)."""
    return df.orderBy(*(order_by or df.columns)).limit(n)


def describe_typed(df: DataFrame) -> DataFrame:
    """Long-form summary: one row per numeric or string column.

    Columns: column_name, n (non-NULL count), mean, stddev (sample), min_num,
    max_num (numeric columns), min_text, max_text (string columns). Date and
    timestamp columns are left out, as `describe()` does.
    """
    fields = [f for f in df.schema.fields if isinstance(f.dataType, (*_NUMERIC, T.StringType))]
    aggs = []
    for i, f in enumerate(fields):
        c = F.col(f.name)
        aggs.append(F.count(c).alias(f"n{i}"))
        if isinstance(f.dataType, _NUMERIC):
            x = c.cast("double")
            aggs += [F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
                     F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        else:
            aggs += [F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, f in enumerate(fields):
        numeric = isinstance(f.dataType, _NUMERIC)
        none_d, none_s = F.lit(None).cast("double"), F.lit(None).cast("string")
        rows.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.col(f"n{i}").alias("n"),
                (F.col(f"a{i}") if numeric else none_d).alias("mean"),
                (F.col(f"s{i}") if numeric else none_d).alias("stddev"),
                (F.col(f"lo{i}") if numeric else none_d).alias("min_num"),
                (F.col(f"hi{i}") if numeric else none_d).alias("max_num"),
                (none_s if numeric else F.col(f"lo{i}")).alias("min_text"),
                (none_s if numeric else F.col(f"hi{i}")).alias("max_text"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: number of NULLs per column, named after the column."""
    return df.select([F.sum(F.col(c).isNull().cast("int")).cast("long").alias(c) for c in df.columns])


def null_nan_profile(df: DataFrame) -> DataFrame:
    """One row: number of NULL-or-NaN values per column (NaN only for float columns)."""
    return df.select([F.count(F.when(is_missing(f), F.lit(1))).alias(f.name) for f in df.schema.fields])


def profile_while_writing(df: DataFrame, write: Callable[[DataFrame], Any]) -> DataFrame:
    """The row of `null_nan_profile` and n_rows, counted by the write of df itself instead of another pass.

    write gets the watched DataFrame and has to write it whole, once. Rows are
    counted as they pass, so a task that runs again doesn't count twice.
    """
    seen = Observation()
    counts = [F.count(F.when(is_missing(f), F.lit(1))).alias(f.name) for f in df.schema.fields]
    write(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *counts))
    found = seen.get
    names = ["n_rows", *df.columns]
    return df.sparkSession.createDataFrame([tuple(found[n] for n in names)], T.StructType([T.StructField(n, T.LongType()) for n in names]))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Number of distinct values, NULL counted as a value (like distinct().count())."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("n_distinct"))


def distinct_with_null(column: str):
    """Distinct values of `column` with NULL counted as a value, as an aggregate
    expression (like `select(column).distinct().count()`)."""
    return F.count_distinct(F.col(column)) + F.max(F.col(column).isNull().cast("long"))


def key_counts(df: DataFrame, user_col: str = "userId", item_col: str = "movieId") -> DataFrame:
    """Rows, distinct users and distinct movies (NULL counted as a value), one row,
    from a single aggregate pass over `df`."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(distinct_with_null(user_col), F.lit(0)).alias("n_users"),
        F.coalesce(distinct_with_null(item_col), F.lit(0)).alias("n_movies"),
    )
