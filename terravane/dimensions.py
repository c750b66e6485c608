"""Small lookup dimensions with a fixed size, safe to broadcast."""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import fixed_values as fixed

CITY_JSON_TYPE = T.MapType(
    T.StringType(),
    T.StructType([
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ]),
)


def _local(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A table held in the plan itself, so its size is known to the optimizer."""
    return spark.createDataFrame(pa.table(columns))


def cities(spark: SparkSession) -> DataFrame:
    """city, latitude, longitude"""
    return _local(spark, {
        "city": [c[0] for c in fixed.CITIES],
        "latitude": [c[2] for c in fixed.CITIES],
        "longitude": [c[3] for c in fixed.CITIES],
    })


def city_codes(spark: SparkSession) -> DataFrame:
    """city, iso3"""
    return _local(spark, {
        "city": [c[0] for c in fixed.CITIES],
        "iso3": [c[1] for c in fixed.CITIES],
    })


def country_codes(spark: SparkSession) -> DataFrame:
    """country, iso3 -- the short list matched by exact spelling"""
    return _local(spark, {
        "country": [c[0] for c in fixed.COUNTRY_CODES],
        "iso3": [c[1] for c in fixed.COUNTRY_CODES],
    })


def cities_from_json(df: DataFrame, column: str = "value") -> DataFrame:
    """City dimension from a JSON object keyed by city name."""
    entries = F.explode(F.from_json(F.col(column), CITY_JSON_TYPE)).alias("city", "at")
    return df.select(entries).select("city", "at.latitude", "at.longitude")


@lru_cache(maxsize=1)
def _registered_countries(spark: SparkSession) -> tuple[tuple[str, str], ...]:
    """(alpha-3, register name) of every ISO 3166 country known to the Java runtime."""
    locale = spark._jvm.java.util.Locale
    official = dict(fixed.ISO_REGISTER_NAMES)
    rows = []
    for alpha2 in locale.getISOCountries():
        country = locale("", alpha2)
        alpha3 = country.getISO3Country()
        rows.append((alpha3, official.get(alpha3, country.getDisplayCountry(locale.ENGLISH))))
    return tuple(rows)


def iso_register(spark: SparkSession) -> DataFrame:
    """name, alpha3"""
    rows = _registered_countries(spark)
    return _local(spark, {"name": [r[1] for r in rows], "alpha3": [r[0] for r in rows]})


def name_corrections(spark: SparkSession) -> DataFrame:
    """name, corrected"""
    return _local(spark, {
        "name": [c[0] for c in fixed.COUNTRY_NAME_CORRECTIONS],
        "corrected": pa.array([c[1] for c in fixed.COUNTRY_NAME_CORRECTIONS], pa.string()),
    })


def country_name_codes(
    spark: SparkSession,
    corrections: DataFrame | None = None,
    register: DataFrame | None = None,
) -> DataFrame:
    """name_key, alpha3: corrections and register composed into one dimension.

    Both lookups ignore case (title-casing a name before looking it up is the same as
    comparing lower-cased names), so a row needs one join on ``lower(strip(name))``
    instead of title-casing and two joins. A correction hides the register entry of
    the same name even when it leads nowhere.
    """
    if corrections is None and register is None:
        codes = {name.lower(): alpha3 for alpha3, name in _registered_countries(spark)}
        codes |= {
            name.lower(): codes.get(corrected.lower()) if corrected else None
            for name, corrected in fixed.COUNTRY_NAME_CORRECTIONS
        }
        return _local(spark, {
            "name_key": list(codes), "alpha3": pa.array(codes.values(), pa.string()),
        })
    corrections = name_corrections(spark) if corrections is None else corrections
    register = iso_register(spark) if register is None else register
    codes = register.select(F.lower("name").alias("name_key"), "alpha3")
    fixes = corrections.select(
        F.lower("name").alias("name_key"), F.lower("corrected").alias("target_key")
    )
    corrected = fixes.join(
        codes.withColumnRenamed("name_key", "target_key"), "target_key", "left"
    ).select("name_key", "alpha3")
    return codes.join(fixes, "name_key", "left_anti").unionByName(corrected)
