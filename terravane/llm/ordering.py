"""Rows dealt into consecutive key ranges, running totals over them, and total text sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of a text column; one scan, one number to the driver."""
    return df.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0


def pieces_for(total_bytes: int, piece_bytes: int) -> int:
    return max(1, -(-total_bytes // piece_bytes))


def range_bounds(df: DataFrame, key: str, parts: int) -> list[int]:
    """Existing key values that cut the rows into about equal ranges; at most parts - 1."""
    if parts < 2:
        return []
    cuts = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(key, cuts, 20_000)).first()[0] or []
    lowest = df.agg(F.min(key)).first()[0]
    return sorted({b for b in found if b != lowest})


def part_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below the key (null: 0), as a tree of comparisons."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < bounds[middle], between(low, middle)).otherwise(
            between(middle + 1, high))

    return F.when(key.isNull(), F.lit(0)).otherwise(between(0, len(bounds)))


def in_key_order(df: DataFrame, key: str, parts: int | None = None, *, ties: list[str] = (),
                 next_heads: bool = False) -> DataFrame:
    """Rows in consecutive key ranges, one per partition, sorted inside (nulls first).

    Adds ``_part`` and ``_guest``. With `next_heads`, the rows that hold the first key of the
    next range (after the last range: of the first) are sent along as guests, so that a
    partition can see the row that follows its last one. Equal keys share a partition.
    """
    parts = parts or shuffle_parts(df)
    bounds = range_bounds(df, key, parts)
    last = len(bounds)
    own = df.withColumn("_part", part_of(F.col(key), bounds)).withColumn("_guest", F.lit(False))
    if next_heads:
        lowest = df.agg(F.min(key), F.count(F.when(F.col(key).isNull(), 1))).first()
        is_first = F.col(key).isNull() if lowest[1] else F.col(key) == F.lit(lowest[0])
        is_head = is_first if not bounds else is_first | F.col(key).isin(bounds)
        before = F.when(F.col("_part") == 0, F.lit(last)).otherwise(F.col("_part") - 1)
        copies = F.when(is_head, F.array(
            F.struct(F.col("_part").alias("p"), F.lit(False).alias("g")),
            F.struct(before.alias("p"), F.lit(True).alias("g")),
        )).otherwise(F.array(F.struct(F.col("_part").alias("p"), F.lit(False).alias("g"))))
        own = (own.withColumn("_copy", F.explode(copies))
               .withColumn("_part", F.col("_copy.p")).withColumn("_guest", F.col("_copy.g"))
               .drop("_copy"))
    return own.repartitionById(last + 1, "_part").sortWithinPartitions(
        F.col("_guest"), F.col(key).asc_nulls_first(), *ties)


def running_total(df: DataFrame, part: str, order: list[str], value: str, out: str) -> DataFrame:
    """Sum of `value` over all rows before each one, in (part, order).

    Only one row per part goes through a single task; inside a part the window is its own.
    """
    totals = df.groupBy(part).agg(F.sum(value).alias("_sum"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(part, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(offsets, part)
            .withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_base"))
