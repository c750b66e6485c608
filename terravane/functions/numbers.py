"""Lenient numeric casts and range rules.

``num`` is the only way text becomes a number: bad text and NaN both give NULL, so
later comparisons never meet NaN (which Spark orders above every number).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.functions.strings import _col

# Exponents that overflow a double are no numbers, those that underflow give zero.
_EXPONENT = r"[eE](?:-[0-9]+|\+?0*(?:[0-9]{1,2}|[12][0-9]{2}|30[0-8]))"
_DECIMAL = rf"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:{_EXPONENT})?"
_INFINITE = "[+-]?[iI][nN][fF](?:[iI][nN][iI][tT][yY])?"
_NUMBER = rf"^\s*({_DECIMAL}|{_INFINITE})\s*$"


def num(c: Column | str) -> Column:
    """Text -> double; anything that is not a plain decimal number gives NULL.

    The text is used once in the expression, so nesting it in range rules, or pushing
    those below other operators, does not multiply the work.
    """
    return F.regexp_extract(_col(c).cast("string"), _NUMBER, 1).try_cast("double")


def as_number(c: Column | str, data_type: T.DataType) -> Column:
    """``num`` for text columns, a plain cast for columns that are numeric already."""
    if isinstance(data_type, T.StringType):
        return num(c)
    return nan_to_null(_col(c).cast("double"))


def nan_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(~F.isnan(c), c)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it.

    Otherwise a rule that names its input twice doubles the parsing below it each time
    the optimizer merges projections or pushes a filter down.
    """
    return F.transform(F.array(value), body)[0]


def integral(c: Column | str) -> Column:
    """Double -> bigint where it holds a whole number in range, else NULL."""
    return let(_col(c), lambda x: F.when(x == F.floor(x), x.try_cast("bigint")))


def missing_if(c: Column | str, sentinels: Iterable[str]) -> Column:
    c = _col(c)
    return F.when(~c.isin(list(sentinels)), c)


def null_below(c: Column | str, bound) -> Column:
    c = _col(c)
    return F.when(c >= bound, c)


def null_outside(c: Column | str, bounds: tuple) -> Column:
    c = _col(c)
    return F.when(c.between(*bounds), c)


def latitude(c: Column | str) -> Column:
    """``57.05N`` / ``23.1s`` / ``12.5`` -> signed degrees."""
    return _signed(c, positive="N", negative="S")


def longitude(c: Column | str) -> Column:
    """``10.33E`` / ``0.13W`` / ``12.5`` -> signed degrees."""
    return _signed(c, positive="E", negative="W")


def _signed(c: Column | str, positive: str, negative: str) -> Column:
    c = _col(c).cast("string")
    upper = F.upper(c)
    return num(
        F.when(upper.endswith(negative), F.concat(F.lit("-"), F.rtrim(upper, F.lit(negative))))
        .when(upper.endswith(positive), F.rtrim(upper, F.lit(positive)))
        .otherwise(c)
    )
