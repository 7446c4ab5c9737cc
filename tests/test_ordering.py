"""Global numbering and the seeded shuffle: the same for any partitioning."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelstats.operators import ordering
from tests.conftest import rows


def table(spark, n=997):
    return spark.createDataFrame([(i % 100, i * 7919 % 1000, float(i % 9)) for i in range(n)] + [(None, 1, 1.0), (3, None, None)], "userId int, movieId int, rating double")


def test_numbers_follow_the_order(spark):
    df = spark.range(0, 5000, 1, 13).withColumn("x", (F.col("id") * 37) % 5000)
    out = ordering.numbered(df, [F.desc("x")], partitions=9, start=100)
    assert out.where("position <> 100 + 4999 - x").isEmpty() and out.count() == 5000
    assert ordering.numbered(df.limit(0), [F.desc("x")]).count() == 0


def test_shuffle_does_not_depend_on_partitions(spark):
    df = table(spark)
    one = ordering.shuffled(df.coalesce(1), ["userId", "movieId"], 7, partitions=1)
    many = ordering.shuffled(df.repartition(50), ["userId", "movieId"], 7, partitions=50)
    assert rows(one) == rows(many)
    assert sorted(r["position"] for r in one.collect()) == list(range(df.count()))
    assert rows(one) != rows(ordering.shuffled(df, ["userId", "movieId"], 8))
    # no trace of the input order: neighbours in the shuffle are far apart in the input
    place = {(r["userId"], r["movieId"], r["rating"]): r["position"] for r in one.collect()}
    moved = [abs(place[tuple(r)] - i) for i, r in enumerate(df.collect())]
    assert sum(moved) / len(moved) > 200


def test_split_is_exact_and_complete(spark):
    df = table(spark)
    train, test = ordering.shuffled_split(df, ["userId", "movieId"], 7, 0.8)
    assert (train.count(), test.count()) == (int(999 * 0.8), 999 - int(999 * 0.8))
    assert rows(train.unionByName(test), df.columns) == rows(df)
