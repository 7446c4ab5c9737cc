"""Joins of a large table with one row per key, split for hot keys.

AQE's skew-join split applies only when both join inputs are plain shuffle
stages; a per-key side that is an aggregate (the usual case here) does not
qualify. `salted_join` therefore splits hot keys itself: the per-key side
knows how many rows of the large side each key has (an exact count or an upper
bound), so a key with more than `hot_rows` rows is cut into
ceil(rows / hot_rows) pieces. Rows of the large side pick their piece from a
hash of their own content (deterministic, so a retried task sends every row
to the same piece); the key's single row on the other side is copied once per
piece. The join result is exactly the plain join's.

A key is in the list of hot keys only with more than `hot_rows` rows, so the
list has at most (rows of the large side) / `hot_rows` entries of two numbers:
2.5 million for 5 * 10^12 rows, some 40 MB. That bound is what makes its
broadcast safe; `hot_rows` sets it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_HOT_ROWS = 2_000_000
# Rows without a key match nothing; a left join spreads them over this many pieces.
NULL_PIECES = 1024


def hot_keys(counts: DataFrame, key: str, count_col: str, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """(key, _pieces) for every key with more than `hot_rows` rows."""
    return counts.where(F.col(count_col) > hot_rows).select(
        key, F.ceil(F.col(count_col) / F.lit(hot_rows)).cast("int").alias("_pieces")
    )


def salted_join(
    large: DataFrame,
    per_key: DataFrame,
    key: str,
    how: str = "inner",
    count_col: str = "n",
    hot_rows: int | None = DEFAULT_HOT_ROWS,
    salt_cols: list[str] | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """`large.join(per_key, key, how)` for how in ("inner", "left"), with hot keys split.

    `per_key` has one row per key. `counts` (default: `per_key`) has one row per
    key of `large` with `count_col` = its rows there, or an upper bound; pass it
    where `per_key` may lack keys of `large`. `salt_cols` should tell the rows of
    one key apart (default: all other columns of `large`). `hot_rows=None` gives
    the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    if hot_rows is None:
        return large.join(per_key, key, how)
    hot = F.broadcast(hot_keys(per_key if counts is None else counts, key, count_col, hot_rows))
    spread = F.xxhash64(*(salt_cols or [c for c in large.columns if c != key]))
    pieces = F.col("_pieces")
    n = F.when(F.col(key).isNull(), NULL_PIECES).otherwise(F.coalesce(pieces, F.lit(1)))
    big = large.join(hot, key, "left").select(*large.columns, F.pmod(spread, n).cast("int").alias("_salt"))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(pieces, F.lit(1)) - 1))
    small = per_key.join(hot, key, "left").select(*per_key.columns, copies.alias("_salt"))
    joined = big.join(small, [key, "_salt"], how)
    return joined.select(key, *[c for c in large.columns if c != key],
                         *[c for c in per_key.columns if c != key])
