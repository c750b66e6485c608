"""Operators over whole tables: union, source choice, upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*parts: DataFrame) -> DataFrame:
    """Union by column name; a column absent from a part is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def primary_or_backup(primary: DataFrame | None, backup: DataFrame) -> DataFrame:
    """All of the primary, or all of the backup if the primary failed or is empty.

    ``None`` stands for a primary that failed. Emptiness is a subquery that stops at
    the first row, so the choice is made while the query runs and only one side is read.
    """
    if primary is None:
        return backup
    spare = backup.filter(~primary.limit(1).select(F.lit(1).alias("one")).exists())
    return primary.unionByName(spare)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows with the same key; the other rows are kept.

    Missing keys never match. The query fails if a complete key occurs twice in the source,
    as it would be open which row wins.
    """
    complete = source.dropna("any", subset=list(keys))
    repeated = complete.groupBy(*keys).count().filter("count > 1").limit(1).select(
        F.lit(1).alias("one"))
    source = source.filter(F.when(repeated.exists(), F.raise_error(
        F.lit("a key occurs twice in the source")).cast("boolean")).otherwise(F.lit(True)))
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))
