"""Mixing sources to target weights (operator 10).

A document's size is its number of words `[^\\x20\\x09-\\x0D]+` (null text: 0).
Sources in code-point order, null last, weigh 5, 2, 1, 5, 2, 1, ... and share
150 % of all sizes; a target stops at twice its source's size and the excess
is shared again by weight, until none is above. In closed form: sources in
ascending order of size / weight are capped as long as the even share of what
is left exceeds their cap; all others get weight times the last share.

A source's rate is target / size. Each document goes out floor(rate) times,
plus once more with probability equal to the fraction: a draw that is a hash
of the seed and the doc_id, so reruns agree.

Defined cases: null and empty texts have size 0; a null source is a source of
its own; a source of size 0 has target 0; rows that repeat a doc_id share one
draw; a null doc_id draws as the text 'null'; an empty table gives an empty
result. Input columns are kept by `mix`, internal ones start with `_mix_`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelstats.llm.tables import WORD

#: The repeating weights and the share of all sizes, in halves.
WEIGHTS = (5, 2, 1)
SHARE_HALVES = 3
MAX_REPEATS = 2
SEED = "mix-1"

_BIG = "decimal(38,0)"


def _size(column: str = "text"):
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """_mix_source, _mix_total (long), _mix_target (double): one row per source.

    The windows run over one row per source, after the sums.
    """
    total = sizes.groupBy("_mix_source").agg(F.sum("_mix_size").alias("_mix_total"))
    by_name = W.orderBy(F.col("_mix_source").asc_nulls_last())
    n = len(WEIGHTS)
    weighted = total.withColumn("_rank", (F.row_number().over(by_name) - 1) % n).withColumn(
        "_w", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("_rank") + 1).cast("long")
    )
    every = W.partitionBy()
    by_ratio = W.orderBy(F.col("_mix_total") / F.col("_w"), F.col("_mix_source").asc_nulls_last())
    filled = (
        weighted.withColumn("_budget", F.sum("_mix_total").over(every).cast(_BIG) * SHARE_HALVES)
        .withColumn("_before", F.coalesce(F.sum(F.col("_mix_total") * 2 * MAX_REPEATS).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast(_BIG))
        .withColumn("_rest", F.sum("_w").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_left", (F.col("_budget") - F.col("_before")).cast(_BIG))
        .withColumn("_capped", (F.col("_mix_total") * 2 * MAX_REPEATS).cast(_BIG) * F.col("_rest") <= F.col("_left") * F.col("_w"))
    )
    # the first source that isn't capped has the share that holds for all after it
    free = F.struct(F.col("_left").cast("double").alias("num"), (F.col("_rest") * 2).cast("double").alias("den"))
    first = F.first(F.when(~F.col("_capped"), free), ignorenulls=True).over(by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return filled.withColumn("_share", first).select(
        "_mix_source", "_mix_total",
        F.when(F.col("_capped"), (F.col("_mix_total") * MAX_REPEATS).cast("double"))
        .otherwise(F.col("_w").cast("double") * F.col("_share.num") / F.col("_share.den")).alias("_mix_target"),
    )


def plan_copies(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """All input columns plus _mix_size, _mix_total, _mix_target and _mix_copies (int)."""
    sized = docs.withColumn("_mix_source", F.col(source)).withColumn("_mix_size", _size(text))
    targets = source_targets(docs.select(F.col(source).alias("_mix_source"), _size(text).alias("_mix_size")))
    rate = F.when(F.col("_mix_total") > 0, F.col("_mix_target") / F.col("_mix_total")).otherwise(0.0)
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))), 1, 12), 16, 10).cast("double") / float(1 << 48)
    targets = targets.withColumnRenamed("_mix_source", "_mix_name")
    # null-safe equality in two equi-join columns; AQE splits a hot source
    joined = sized.join(
        targets,
        (F.coalesce(sized["_mix_source"], F.lit("")) == F.coalesce(targets["_mix_name"], F.lit("")))
        & (sized["_mix_source"].isNull() == targets["_mix_name"].isNull()),
        "left",
    )
    return joined.withColumn("_mix_copies", (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")).drop("_mix_source", "_mix_name")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: each row as often as its copies, with the input's columns."""
    planned = plan_copies(docs)
    return planned.where("_mix_copies > 0").withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), "_mix_copies"))).select(docs.columns)


def mix_report(docs: DataFrame) -> DataFrame:
    return plan_copies(docs.select("doc_id", "source", "text")).select(
        "doc_id", F.col("_mix_size").alias("size"), F.col("_mix_total").alias("source_size"), F.col("_mix_target").alias("target"),
        (F.col("_mix_size") * F.col("_mix_copies")).cast("long").alias("taken"),
    )
