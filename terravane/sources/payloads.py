"""Landed API payloads (one JSON text per row) -> typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.functions.dates import daily_sequence, lenient_timestamp
from terravane.operators.joins import add_coordinates

WEATHER_TYPE = (
    "city string, daily struct<start: string, end: string, "
    "temperature_2m_mean: array<double>>"
)
STATION_TYPE = (
    "aqi: string, iaqi: struct<pm25: struct<v: double>, pm10: struct<v: double>, "
    "no2: struct<v: double>>"
)


def dated_values(df: DataFrame, start: Column, end: Column, values: Column,
                 value_name: str = "value") -> DataFrame:
    """One row per day of [start, end] with the value at the same place in the array.

    The shorter side is padded with NULL, as arrays_zip does.
    """
    pairs = F.arrays_zip(daily_sequence(start, end).alias("date"), values.alias(value_name))
    return df.select("*", F.inline(pairs).alias("date", value_name))


def daily_weather(payloads: DataFrame, value: str = "value",
                  cities: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(date, temperature_2m_mean, city, latitude, longitude; rejected payloads).

    Rejected are payloads without a city, of an unknown one, without a readable first and
    last day in this order, or with another number of values than days. A bad payload
    costs its own city only.
    """
    parsed = payloads.select(F.from_json(F.col(value), WEATHER_TYPE).alias("p")).select("p.*")
    first, last = (lenient_timestamp(f"daily.{end}").cast("date") for end in ("start", "end"))
    values = F.col("daily.temperature_2m_mean")
    checked = parsed.withColumns({"_first": first, "_last": last}).withColumn("_fits", F.coalesce(
        F.col("city").isNotNull() & (F.col("_first") <= F.col("_last"))
        & (F.size(values) == F.datediff("_last", "_first") + 1), F.lit(False)))
    known, unknown = add_coordinates(checked.filter("_fits"), "city", cities)
    rejected = checked.filter("not _fits").unionByName(unknown).drop("_first", "_last", "_fits")
    # Filters may move; a range that does not fit must be harmless wherever it is evaluated.
    start = F.when(F.col("_first") <= F.col("_last"), F.col("_first"))
    days = dated_values(known, start, F.col("_last"), values, "temperature_2m_mean")
    columns = ["date", "temperature_2m_mean", "city", "latitude", "longitude"]
    return days.select(*columns), rejected


def station_readings(payloads: DataFrame, value: str = "value", city: str = "city",
                     day: Column | None = None) -> DataFrame:
    """city, date, aqi, pm25, pm10, no2 of the payloads whose status is ok.

    The status is checked before the data is read as an object, because a failed
    payload carries a text there. ``day`` is the reading date, today by default.
    """
    status = F.get_json_object(F.col(value), "$.status")
    parsed = F.from_json(F.col(value), f"data struct<{STATION_TYPE}>")
    return (
        payloads.filter(status == "ok").withColumn("_d", parsed["data"])
        .select(
            F.col(city).alias("city"), (F.current_date() if day is None else day).alias("date"),
            F.col("_d.aqi").alias("aqi"), F.col("_d.iaqi.pm25.v").alias("pm25"),
            F.col("_d.iaqi.pm10.v").alias("pm10"), F.col("_d.iaqi.no2.v").alias("no2"),
        )
    )
