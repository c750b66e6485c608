"""API payloads -> landing zone: split off bad payloads, choose the source, coerce, write.

A payload that cannot be read costs its own city only and is returned with the rejects.
The backup table stands in, as a whole, when no payload could be read at all, or with
``backup_if="any"`` as soon as one could not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.functions import dates, numbers
from terravane.functions.names import sanitize_columns
from terravane.operators import columns
from terravane.operators.tables import primary_or_backup
from terravane.sources import landing, payloads

WEATHER_TABLE = "historical_weather"
STATION_TABLE = "Current_air_quality_data"
STATION_NUMBERS = ("aqi", "pm25", "pm10", "no2")


def _as_type(df: DataFrame, name: str, data_type: T.DataType) -> Column:
    raw = df.schema[name].dataType
    if isinstance(data_type, T.DoubleType):
        return numbers.as_number(name, raw)
    if isinstance(data_type, T.DateType):
        return dates.as_timestamp(name, raw, dates.DATE_TIME_FORMAT).cast("date")
    return F.col(name).cast(data_type)


def shaped_like(backup: DataFrame, primary: DataFrame) -> DataFrame:
    """The primary's columns of a backup, by sanitised name; absent ones are NULL."""
    backup = sanitize_columns(backup)
    return backup.select(*[
        (_as_type(backup, f.name, f.dataType) if f.name in backup.columns
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in primary.schema])


def _land(rows: DataFrame, rejected: DataFrame, backup: DataFrame | None, backup_if: str, root: str,
          name: str, mode: str) -> str:
    if backup_if not in ("all", "any"):
        raise ValueError(f"backup_if is 'all' or 'any', not {backup_if!r}")
    rows = sanitize_columns(rows)
    if backup is not None:
        if backup_if == "any":
            rows = rows.filter(~rejected.limit(1).select(F.lit(1).alias("one")).exists())
        rows = primary_or_backup(rows, shaped_like(backup, rows))
    return landing.write_table(rows, root, name, mode)


def land_weather(raw: DataFrame, root: str, backup: DataFrame | None = None,
                 name: str = WEATHER_TABLE, cities: DataFrame | None = None,
                 mode: str = "overwrite", backup_if: str = "all") -> DataFrame:
    """Land one row per city and day of weather payloads (column ``value``).

    Returns the rejected payloads; see ``payloads.daily_weather`` for what is rejected.
    ``backup_if`` says when the backup lands instead: if all payloads are rejected, or any.
    """
    days, rejected = payloads.daily_weather(raw, cities=cities)
    _land(days, rejected, backup, backup_if, root, name, mode)
    return rejected


def land_stations(raw: DataFrame, root: str, backup: DataFrame | None = None,
                  name: str = STATION_TABLE, day: Column | None = None,
                  mode: str = "overwrite", backup_if: str = "all") -> DataFrame:
    """Land one reading per station payload (columns ``city`` and ``value``) as numbers.

    Returns the payloads without an ok status; ``backup_if`` as in ``land_weather``.
    """
    readings = payloads.station_readings(raw, day=day)
    ok = F.get_json_object("value", "$.status") == "ok"
    rejected = raw.filter(~F.coalesce(ok, F.lit(False)))
    _land(columns.to_numbers(readings, *STATION_NUMBERS), rejected, backup, backup_if, root, name, mode)
    return rejected
