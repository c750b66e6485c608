"""De-duplication.

"First" needs an order that Spark tables do not have by themselves. Landing adds the
``_ordinal`` column (see ``sources.landing``); callers may name their own order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDINAL = "_ordinal"


def with_row_order(df: DataFrame, order_by: Sequence | None) -> tuple[DataFrame, list]:
    """The frame and the columns that give its row order.

    Without an explicit order or a landed ordinal the values of the rows give it, column by
    column: the order of a scan changes with the packing of its files.
    """
    if order_by:
        return df, list(order_by)
    if ORDINAL in df.columns:
        return df, [ORDINAL]
    return df, [F.col(f"`{f.name}`") for f in df.schema
                if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def keep_first(df: DataFrame, keys: Sequence[Column | str], order_by: Sequence) -> DataFrame:
    """First row per key in the given order; missing keys are equal to each other.

    Spark plans the ``= 1`` filter as a group limit on both sides of the shuffle, so
    each map task sends at most one row per key and a hot key stays cheap.
    """
    first = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_position", F.row_number().over(first))
            .filter(F.col("_position") == 1).drop("_position"))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct over the data columns.

    The landed ordinal is no data and is dropped: equal rows are interchangeable, and
    without it the duplicates are hashed away before and after the shuffle.
    """
    return df.drop(ORDINAL).dropDuplicates()


def dedup_audit(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows before and after de-duplication on ``keys`` (all columns if None)."""
    keys = list(keys or [c for c in df.columns if c != ORDINAL])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_out"),
    )
