"""Date and time expressions. The session time zone is expected to be UTC."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.functions.numbers import num
from terravane.functions.strings import _col, strip

DATE_FORMAT = "yyyy-MM-dd"
# A date with an optional time of day and an optional zone offset.
DATE_TIME_FORMAT = "yyyy-MM-dd[' 'HH:mm:ss[XXX]]"


def lenient_timestamp(c: Column | str, *formats: str) -> Column:
    """Parse with the declared formats, first match wins; other text gives NULL."""
    text = strip(_col(c).cast("string"))
    return F.coalesce(
        *[F.try_to_timestamp(text, F.lit(f)) for f in (formats or (DATE_FORMAT,))]
    )


def as_timestamp(c: Column | str, data_type: T.DataType, *formats: str) -> Column:
    """``lenient_timestamp`` for text, a plain cast for columns that are dates already."""
    if isinstance(data_type, T.StringType):
        return lenient_timestamp(c, *formats)
    return _col(c).cast("timestamp")


def strict_timestamp(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Parse with one format; text that does not match fails the query."""
    c = _col(c)
    return F.when(c.isNotNull(), F.coalesce(
        F.try_to_timestamp(c, F.lit(fmt)),
        F.raise_error(F.concat(F.lit(f"not in format {fmt}: "), c)).cast("timestamp"),
    ))


def iso_instant(c: Column | str) -> Column:
    """ISO-8601 instant (``Z`` or an offset allowed) -> timestamp, else NULL."""
    text = strip(_col(c).cast("string"))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def date_from_parts(year: Column, month: Column, day: Column, mode: str = "start") -> Column:
    """Timestamp at midnight from three text or number parts.

    A missing month becomes 1 (``start``) or 12 (``end``); a missing day becomes the
    first or the last day of the month. A missing year or an impossible date gives NULL.
    """
    if mode not in ("start", "end"):
        raise ValueError(f"mode must be 'start' or 'end', not {mode!r}")
    y, m, d = (num(p).try_cast("int") for p in (year, month, day))
    m = F.coalesce(m, F.lit(1 if mode == "start" else 12))
    zero = F.lit(0)

    def at(the_day: Column) -> Column:
        return F.try_make_timestamp(years=y, months=m, days=the_day,
                                    hours=zero, mins=zero, secs=zero.cast("decimal(16,6)"))

    if mode == "start":
        return at(F.coalesce(d, F.lit(1)))
    month_end = F.last_day(at(F.lit(1)).cast("date")).cast("timestamp")
    return F.when(d.isNull(), month_end).otherwise(at(d))


def daily_sequence(start: Column, end: Column) -> Column:
    return F.sequence(start, end, F.expr("interval 1 day"))


def year_between(c: Column | str, first: int, last: int) -> Column:
    """Year range as a timestamp range, which Spark can push into the scan."""
    c = _col(c)
    return ((c >= F.lit(date(first, 1, 1)).cast("timestamp"))
            & (c < F.lit(date(last + 1, 1, 1)).cast("timestamp")))
