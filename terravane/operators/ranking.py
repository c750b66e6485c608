"""Rankings, top-k and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.operators.dedup import ORDINAL, with_row_order
from terravane.staging import enable_checkpoints

MEDALS = ["🥇", "🥈", "🥉"]


def net_score(positive: str = "positive", negative: str = "negative") -> Column:
    """positive - negative, a missing counter being zero."""
    zero = F.lit(0).cast("bigint")
    return F.coalesce(F.col(positive), zero) - F.coalesce(F.col(negative), zero)


def medal(position: Column) -> Column:
    text = F.lit("")
    for place, sign in enumerate(MEDALS, start=1):
        text = F.when(position == place, F.lit(sign)).otherwise(text)
    return text


def number_rows(df: DataFrame, order_by: Sequence, alias: str = "position") -> DataFrame:
    """Number all rows 1, 2, ... in a total order, without a single-task window.

    The rows are range-partitioned and sorted once and pinned with a checkpoint, as
    both passes below must see the same partitions. A row's number is its place inside
    its partition plus the sizes of the partitions before; only those sizes (one row
    per partition) are summed in one task.
    """
    enable_checkpoints(df.sparkSession)
    local_bits = 33
    pinned = (df.orderBy(*order_by)
              .withColumn("_place", F.monotonically_increasing_id())
              .checkpoint())
    part = F.shiftright("_place", local_bits)
    in_order = Window.orderBy("_part")
    sizes = pinned.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_part", (F.sum("_size").over(in_order) - F.col("_size")).alias("_offset"))
    local = F.col("_place") - F.shiftleft(part, local_bits)
    return (pinned.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(alias, F.col("_offset") + local + 1)
            .drop("_part", "_place", "_offset"))


def latest(df: DataFrame, time: str, n: int = 10, *tie_break: Column) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(time), *tie_break).limit(n)


def head(df: DataFrame, n: int = 5, order_by: Sequence | None = None) -> DataFrame:
    """First rows in row order. Each task keeps n rows; nothing is sorted globally.

    A table without an order gives any n rows, which reads no more than it has to.
    """
    columns = [c for c in df.columns if c != ORDINAL]
    if not order_by and ORDINAL not in df.columns:
        return df.limit(n)
    df, order = with_row_order(df, order_by)
    return df.orderBy(*order).limit(n).select(*columns)


def tail(df: DataFrame, n: int = 5, order_by: Sequence | None = None) -> DataFrame:
    """Last rows in row order: ``order_by``, or the landed ordinal.

    A table with neither has no last rows; the order of a scan depends on file sizes.
    """
    if not order_by and ORDINAL not in df.columns:
        raise ValueError("tail needs order_by or a landed ordinal")
    columns = [c for c in df.columns if c != ORDINAL]
    df, order = with_row_order(df, order_by)
    last = [c.desc() if isinstance(c, Column) else F.desc(c) for c in order]
    return df.orderBy(*last).limit(n).select(*columns)
