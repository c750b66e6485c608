"""Exact medians without gathering a column in one task.

Spark's ``median`` keeps every distinct value of the column in one aggregation buffer. Here
the two middle ranks are found by selection in passes. The first pass counts the values by
sign and order of magnitude, each further pass counts the values of the slice with the
middle rank by equally wide parts of that slice. A pass keeps at most 65,536 counters per
column (with the least and greatest value of each), combined before the shuffle; one row
per column and rank reaches the driver. It ends when the least and greatest value of the
slice are equal: after two or three passes for most data, after five at the latest, as each
further pass settles about sixteen bits of a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Counters per slice and pass.
_SLICES = 1 << 16
# Natural logarithms of the least and greatest positive double lie between these.
_LOG_LOW, _LOG_HIGH = -746.0, 711.0


def exact_medians(df: DataFrame, *names: str) -> DataFrame:
    """One row with the median of each named column; missing values are left out.

    The median of an even number of values is the mean of the middle two. A column
    without values gives NULL. The passes run when this is called.
    """
    numbers = df.select(*[F.nanvl(F.col(n).cast("double"), F.lit(None)).alias(n) for n in names])
    return spread_medians(numbers, *names)


def spread_medians(df: DataFrame, *names: str) -> DataFrame:
    """``exact_medians`` for double columns of any size."""
    found = _medians(df, names)
    return df.sparkSession.createDataFrame(
        [tuple(found)], T.StructType([T.StructField(n, T.DoubleType()) for n in names]))


def _medians(df: DataFrame, names: tuple[str, ...]) -> list[float | None]:
    values = (
        df.select(F.inline(F.array(*[
            F.struct(F.lit(i).alias("c"), F.col(n).alias("v"))
            for i, n in enumerate(names)
        ])))
        .filter(F.col("v").isNotNull())
    )
    by_column = Window.partitionBy("c").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    n = F.sum("n").over(by_column)
    middle = F.array(F.floor((n + 1) / 2), F.floor(n / 2) + 1)  # 1-based, equal if n is odd
    slices = _counted(values, ["c"], _magnitude(F.col("v"))).withColumn(
        "wanted", F.transform(F.array_distinct(middle), lambda r: r.cast("bigint")))
    open_slices = _with_rank(slices, ["c"])
    middles: dict[int, list[float]] = {}
    while True:
        wanted = []
        for r in open_slices.collect():  # at most two rows per column
            if r["low"] == r["high"]:
                middles.setdefault(r["c"], []).append(r["low"])
            else:
                wanted.append((r["c"], len(wanted), r["low"], r["high"], [r["rank"]]))
        if not wanted:
            return [_mean(middles.get(i)) for i in range(len(names))]
        slice_of = df.sparkSession.createDataFrame(
            wanted, "c int, t int, low double, high double, wanted array<bigint>")
        inside = values.join(F.broadcast(slice_of), "c").filter(F.col("v").between(F.col("low"), F.col("high")))
        share = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
        place = F.least(F.floor(share * _SLICES), F.lit(_SLICES - 1)).cast("int")
        counted = _counted(inside, ["c", "t", "wanted"], place)
        open_slices = _with_rank(counted, ["c", "t"])


def _mean(middle: list[float] | None) -> float | None:
    """Mean of the middle value or values; halves first, so that it cannot overflow."""
    if not middle:
        return None
    return middle[0] if middle[0] == middle[-1] else middle[0] * 0.5 + middle[-1] * 0.5


def _magnitude(v: Column) -> Column:
    """Slice by sign and logarithm: never falls as ``v`` grows. Infinities have their own."""
    half = _SLICES // 2 - 2
    size = F.floor((F.log(F.abs(v)) - _LOG_LOW) / (_LOG_HIGH - _LOG_LOW) * half) + 1
    size = F.when(F.abs(v) == float("inf"), half + 1).otherwise(size)
    return (F.when(v > 0, size).when(v < 0, -size).otherwise(0)).cast("int")


def _counted(values: DataFrame, keys: list[str], place: Column) -> DataFrame:
    return values.groupBy(*keys, place.alias("slice")).agg(
        F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def _with_rank(slices: DataFrame, keys: list[str]) -> DataFrame:
    """keys, low, high, rank: the slices that hold a wanted rank, with the rank inside.

    The window runs over counters, at most 65,536 per key, never over values.
    """
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("slice"))
    return (slices.withColumn("last", upto).withColumn("before", F.col("last") - F.col("n"))
            .select(*keys, "low", "high", "before", "last", F.explode("wanted").alias("rank"))
            .filter((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("last")))
            .select(*keys, "low", "high", (F.col("rank") - F.col("before")).alias("rank")))


def approximate_medians(df: DataFrame, *names: str) -> DataFrame:
    """One pass; ranks are off by at most one in ten thousand."""
    return df.agg(*[F.percentile_approx(n, 0.5, 10000).alias(n) for n in names])


def impute_medians(df: DataFrame, *names: str, exact: bool = True) -> DataFrame:
    """Fill the missing values of each named column with the column's median.

    Whole-number columns become double when they are filled, as the median may have a
    fraction. Exact medians are found when this is called and become constants of the plan;
    approximate ones are a subquery of it.
    """
    if not names:
        return df
    if exact:
        found = exact_medians(df, *names).first()
        median = {n: F.lit(found[n]).cast("double") for n in names}
    else:
        row = approximate_medians(df, *names).select(F.struct(*names).alias("m")).scalar()
        median = {n: row.getField(n).cast("double") for n in names}
    filled = {}
    for n in names:
        wide = F.coalesce(F.col(n).cast("double"), median[n])
        is_float = isinstance(df.schema[n].dataType, T.FloatType)
        filled[n] = wide.cast("float") if is_float else wide
    return df.withColumns(filled)
