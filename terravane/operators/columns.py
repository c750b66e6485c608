"""Projection operators: rename, drop, reorder, cast groups of columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.functions import numbers


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def columns_of_type(df: DataFrame, *types: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def present(df: DataFrame, *names: str) -> list[str]:
    return [n for n in names if n in df.columns]


def rename_present(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


def to_numbers(df: DataFrame, *names: str) -> DataFrame:
    """Lenient numeric cast of the named columns that exist."""
    return df.withColumns({
        n: numbers.as_number(n, df.schema[n].dataType) for n in present(df, *names)
    })


def to_whole_numbers(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({
        n: numbers.integral(numbers.as_number(n, df.schema[n].dataType))
        for n in present(df, *names)
    })


def transform_present(df: DataFrame, rule, *names: str) -> DataFrame:
    """Apply ``rule(column)`` to each named column that exists."""
    return df.withColumns({n: rule(F.col(n)) for n in present(df, *names)})


def to_float32(df: DataFrame, *names: str) -> DataFrame:
    """Halve the width of double columns (all of them by default). Lossy: do it last."""
    names = names or tuple(columns_of_type(df, T.DoubleType))
    return df.withColumns({n: F.col(n).cast("float") for n in present(df, *names)})


def add_missing(df: DataFrame, **types: str) -> DataFrame:
    """Add NULL columns for the names that are absent."""
    return df.withColumns({
        n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns
    })


def move_first(df: DataFrame, *names: str) -> DataFrame:
    first = present(df, *names)
    return df.select(*first, *[c for c in df.columns if c not in first])


def move_last(df: DataFrame, *names: str) -> DataFrame:
    last = present(df, *names)
    return df.select(*[c for c in df.columns if c not in last], *last)


def coordinate_pair(df: DataFrame, x: str | None = None, y: str | None = None,
                    fraction: float | None = None, seed: int = 0) -> DataFrame:
    """Two numeric columns as x and y; defaults to the first two of the table.

    ``fraction`` draws a random share of the rows for plotting; None keeps all rows.
    """
    available = numeric_columns(df)
    x = x or (available[0] if available else None)
    y = y or next((c for c in available if c != x), None)
    if x is None or y is None:
        raise ValueError("need two numeric columns")
    pair = df.select(F.col(x).alias("x"), F.col(y).alias("y"))
    return pair if fraction is None else pair.sample(fraction, seed)


def repair_end(start: Column, end: Column) -> Column:
    """An end before its start is lifted to the start."""
    return F.when(start > end, start).otherwise(end)
