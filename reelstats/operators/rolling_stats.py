"""Rating statistics kept up to date month by month.

A store holds the ratings of each calendar month and, for each month, partial
statistics per movie or user: count and sum, which merge by addition. New ratings, in
whatever order they come, touch only the months that they fall in: those are
read, merged, written again and summed up again; all other months' ratings are
neither read nor written. Statistics are the sum of the partials, a table of one
row per key and month.

A rating given again for the same user and movie in the same month replaces the
earlier one (the later timestamp wins, then the higher rating), so a delivery that
is repeated changes nothing, and a fold that failed half-way is simply run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstats.session import scratch_path

MONTH = ["rating_year", "rating_month"]


def _month_number():
    return F.col("rating_year") * 100 + F.col("rating_month")


def _overwrite_months(df: DataFrame, path: str) -> None:
    """Replaces the months that df has, and no others."""
    df.hint("rebalance", *MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH).parquet(path)


def _stored_months(spark: SparkSession, path: str, months: list[int], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path).where(_month_number().isin(months))


def fold_in(ratings: DataFrame, store: str, key: str = "movieId") -> list[int]:
    """Adds ratings (userId, movieId, rating, timestamp) to the store; returns the months touched, as yyyymm.

    key: what statistics are kept for, movieId or userId. Rows with a null are left out.
    """
    spark = ratings.sparkSession
    fields = ["userId", "movieId", "rating", "timestamp"]
    dated = ratings.select(fields).na.drop().withColumn("rating_year", F.year("timestamp")).withColumn("rating_month", F.month("timestamp"))
    path = scratch_path(spark, "new-ratings")
    dated.write.parquet(path)
    new = spark.read.schema(dated.schema).parquet(path)
    months = sorted(r[0] for r in new.select(_month_number()).distinct().collect())  # calendar months
    if not months:
        return []
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dated.schema.fields)
    merged = new.unionByName(_stored_months(spark, f"{store}/ratings", months, types)) if _exists(spark, f"{store}/ratings") else new
    # the newest rating of each user, movie and month; partial maxima first
    best = merged.groupBy("userId", "movieId", *MONTH).agg(F.max(F.struct("timestamp", "rating")).alias("_best"))
    kept = best.select("userId", "movieId", F.col("_best.rating").alias("rating"), F.col("_best.timestamp").alias("timestamp"), *MONTH)
    # the months that are read are replaced only when all tasks have written theirs
    _overwrite_months(kept, f"{store}/ratings")
    kept = _stored_months(spark, f"{store}/ratings", months, types)
    _overwrite_months(kept.groupBy(key, *MONTH).agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total")), f"{store}/partials")
    return months


def _exists(spark: SparkSession, path: str) -> bool:
    from pyspark.errors import AnalysisException

    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def current_stats(spark: SparkSession, store: str, key: str = "movieId", months: list[int] | None = None) -> DataFrame:
    """(key, num_ratings, avg_rating) from the partials, of all months or of those given (as yyyymm)."""
    partials = spark.read.parquet(f"{store}/partials")
    if months is not None:
        partials = partials.where(_month_number().isin(months))
    return partials.groupBy(key).agg(F.sum("n").alias("num_ratings"), (F.sum("total") / F.sum("n")).alias("avg_rating"))
