"""Global numbering, and a seeded shuffle and split that come out the same for any partitioning.

A total order over all rows needs no single task: rows are range-partitioned and
sorted, numbered inside their partition, and shifted by the sizes of the
partitions before it (a table of one row a partition). The numbered rows are
stored once in between, since the borders of a range exchange may move if it runs
again. A shuffle is the order of a keyed hash of the row's key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelstats.session import scratch_path

# monotonically_increasing_id: partition number above, row in the partition below this bit
_ROW_BITS = 33


def numbered(df: DataFrame, order: list[Column], name: str = "position", partitions: int | None = None, start: int = 0) -> DataFrame:
    """df with `name`: every row's place in the given order, from `start`.

    The order should tell all rows apart; rows that it doesn't are numbered in any order.
    """
    width = (partitions,) if partitions else ()
    path = scratch_path(df.sparkSession, "numbered")
    df.repartitionByRange(*width, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    stored = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a partition
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    shift = sizes.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + F.lit(start)).alias("_shift"))
    place = F.col("_shift") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # one row a partition, whatever the input
    return stored.join(F.broadcast(shift), "_part").select(*df.columns, place.alias(name))


def keyed_hash(keys: list[str], seed: int) -> Column:
    """A 60-bit number from the seed and the keys' text, the same in any engine with MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def shuffled(df: DataFrame, keys: list[str], seed: int, name: str = "position", partitions: int | None = None) -> DataFrame:
    """df with `name`: every row's place, from 0, in a random order that only the seed and the rows decide.

    Rows with equal keys follow the order of their other columns.
    """
    rest = [c for c in df.columns if c not in keys]
    hashed = df.withColumn("_hash", keyed_hash(keys, seed))
    order = [F.asc(c) for c in ("_hash", *keys, *rest)]
    return numbered(hashed, order, name, partitions).drop("_hash")


def shuffled_split(df: DataFrame, keys: list[str], seed: int, train_share: float = 0.8, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) of exactly floor(rows * train_share) and the other rows, in shuffled order (position)."""
    out = shuffled(df, keys, seed, partitions=partitions)
    rows = out.agg(F.count(F.lit(1))).first()[0]
    first_test = int(rows * train_share)
    return out.where(F.col("position") < first_test), out.where(F.col("position") >= first_test)
