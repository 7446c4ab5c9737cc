"""Column expressions shared by the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# They must equal the reference's behaviour.
# - the release year is the first "(dddd)" group in the title
# - genres are "|"-separated inside one string
# - a movie unknown to the catalogue is shown with the title "Inconnu"
# - genres are displayed joined by ", "
TITLE_YEAR_PATTERN = r"\((\d{4})\)"
GENRE_SPLIT_REGEX = "[|]"
UNKNOWN_TITLE = "Inconnu"
GENRE_DISPLAY_SEPARATOR = ", "


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_year(title: str | Column = "title") -> Column:
    """Year text out of the title, as INT; NULL when absent or not a number."""
    return F.regexp_extract(_col(title), TITLE_YEAR_PATTERN, 1).try_cast("int")


def genre_array(genres: str | Column = "genres") -> Column:
    return F.split(_col(genres), GENRE_SPLIT_REGEX)


def genre_count(genres: str | Column = "genres") -> Column:
    """Number of genres; an empty string is one (empty) genre, NULL stays NULL."""
    return F.size(genre_array(genres)).cast("int")


def genre_display(genres: str | Column = "genres") -> Column:
    """Genres for display: missing genres show as an empty string."""
    return F.array_join(genre_array(F.coalesce(_col(genres), F.lit(""))), GENRE_DISPLAY_SEPARATOR)


def date_parts(ts: str | Column = "timestamp") -> dict[str, Column]:
    t = _col(ts)
    return {
        "rating_date": F.to_date(t),
        "rating_year": F.year(t),
        "rating_month": F.month(t),
        "rating_day": F.dayofmonth(t),
    }


def activity_tier(count: str | Column, width: int) -> Column:
    """Lower bound of the `width`-wide bucket holding `count` (0, width, 2*width, ...)."""
    return (F.floor(_col(count) / F.lit(width)) * F.lit(width)).cast("long")


def rating_bin(rating: str | Column = "rating", step: float = 0.5) -> Column:
    return F.floor(_col(rating) / F.lit(step)) * F.lit(step)


def round_half_up(c: str | Column, digits: int = 2) -> Column:
    return F.round(_col(c), digits)


def is_missing(field: T.StructField) -> Column:
    """NULL, or NaN for floating columns (isnan is only defined for those)."""
    c = F.col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def present(fields: list[T.StructField]) -> Column:
    """No NULL (nor NaN in floating columns) in any of `fields`: the condition of
    `na.drop("any")`, written as plain predicates so the optimizer can reason about
    them (inferred IS NOT NULL filters become redundant, and equal subplans stay
    equal, so their shuffles are reused)."""
    cond = F.lit(True)
    for f in fields:
        cond = cond & ~is_missing(f)
    return cond


def json_value(*cols: str) -> Column:
    """One JSON document per row, as a message value."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def epoch_seconds(col: str) -> Column:
    """Seconds since 1970 of a time without zone, taken as UTC whatever the session's zone."""
    c = F.col(col)
    days = F.unix_date(F.to_date(c)).cast("long")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
