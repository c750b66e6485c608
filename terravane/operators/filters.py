"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.functions.strings import contains_any, is_not_entity, strip


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def keep_non_negative(df: DataFrame, *names: str) -> DataFrame:
    """Rows where every named column is present and at least zero."""
    return df.filter(_all([F.col(n).isNotNull() & (F.col(n) >= 0) for n in names]))


def keep_between(df: DataFrame, **bounds: tuple) -> DataFrame:
    """Rows where every named column lies in its closed interval (missing is outside)."""
    return df.filter(_all([F.col(n).between(*b) for n, b in bounds.items()]))


def keep_complete(df: DataFrame, *names: str) -> DataFrame:
    return df.dropna(subset=list(names))


def exclude_entity(df: DataFrame, column: str, entity: str, normalize=strip) -> DataFrame:
    return df.filter(is_not_entity(column, entity, normalize))


def mentions_any(df: DataFrame, text: str, words: list[str]) -> DataFrame:
    return df.filter(contains_any(text, words))
