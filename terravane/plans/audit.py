"""What cleaning did to each dataset, in one long table: dataset, check, item, n.

``rows`` and ``repeated`` count the landed rows and those that repeat an earlier key,
``date_unparsed`` the landed rows per text that is no date, ``name_unmatched`` the cleaned
rows per place name without a country code, and ``rule`` the landed rows per broken rule.
Zero counts of rows, repeats and rules are listed, names and dates only where they occur.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane.functions import dates, names, numbers, strings
from terravane.operators import dedup, joins
from terravane.operators.aggregates import null_profile
from terravane.operators.tables import union_all
from terravane.plans.quality import quality_report
from terravane.plans.registry import plan_for

AUDIT_TABLE = "flow_audit"
AUDIT_SCHEMA = "dataset string, check string, item string, n bigint"

# Lower-cased name prefix -> date column and its format.
DATED = {
    "air_quality_index": ("Date", dates.DATE_FORMAT),
    "current_air_quality_data": ("date", dates.DATE_FORMAT),
    "historical_weather": ("date", dates.DATE_TIME_FORMAT),
    "globallandtemperaturesby": ("dt", dates.DATE_TIME_FORMAT),
}
# Cleaned columns that a country code is looked up by, first one present.
NAMED = ("City", "Country", "country", "CountryName")


def _moment(df: DataFrame, name: str, date_format: str) -> Column:
    return dates.as_timestamp(name, df.schema[name].dataType, date_format)


def _station_key(df: DataFrame) -> DataFrame:
    return df.select(strings.strip("city").alias("city"),
                     _moment(df, "date", dates.DATE_FORMAT).alias("at"))


def _weather_key(df: DataFrame) -> DataFrame:
    at = (_moment(df, "date", dates.DATE_TIME_FORMAT) if "date" in df.columns
          else F.lit(None).cast("timestamp"))
    return df.select(strings.strip("city").alias("city"), at.alias("at"))


def _trend_key(df: DataFrame) -> DataFrame:
    df = df.select("Year", strings.strip_quotes(strings.strip("Country")).alias("Country"))
    coded = joins.add_listed_country_code(df, "Country")
    year = numbers.integral(numbers.as_number("Year", df.schema["Year"].dataType))
    return coded.select(year.alias("Year"), "CountryISO")


def _land_key(df: DataFrame) -> DataFrame:
    return df.select("dt", "City", "Country")


# Lower-cased name prefix -> columns that must not repeat; all columns where the plan
# removes equal rows.
KEYS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "current_air_quality_data": _station_key,
    "historical_weather": _weather_key,
    "globalenvironmental": _trend_key,
    "globallandtemperaturesby": _land_key,
    "natural_disaster": lambda df: df.drop(dedup.ORDINAL),
    "world": lambda df: df.drop(dedup.ORDINAL),
}


def _repeats(name: str, raw: DataFrame) -> DataFrame:
    key = plan_for(name, KEYS)
    if key is None:
        lines = [F.struct(F.lit("rows").alias("check"), F.count(F.lit(1)).alias("n"))]
        counted = raw.agg(F.array(*lines).alias("l"))
    else:
        keyed = key(raw)
        keyed = keyed.toDF(*[f"k{i}" for i in range(len(keyed.columns))])
        counted = dedup.dedup_audit(keyed).select(F.array(
            F.struct(F.lit("rows").alias("check"), F.col("rows_in").alias("n")),
            F.struct(F.lit("repeated").alias("check"),
                     (F.col("rows_in") - F.col("rows_out")).alias("n"))).alias("l"))
    return counted.select(F.inline("l")).select("check", F.lit(None).cast("string").alias("item"), "n")


def _per_item(df: DataFrame, check: str, item: Column, bad: Column) -> DataFrame:
    return (df.filter(bad).groupBy(item.cast("string").alias("item"))
            .agg(F.count(F.lit(1)).alias("n")).select(F.lit(check).alias("check"), "item", "n"))


def dataset_audit(name: str, raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Audit of one dataset from its landed and its cleaned rows."""
    parts = [_repeats(name, raw)]
    date = plan_for(name, DATED)
    if date is not None:
        stripped = names.strip_column_names(raw)
        if date[0] in stripped.columns:
            parts.append(_per_item(stripped, "date_unparsed", F.col(date[0]),
                                   _moment(stripped, *date).isNull()))
    place = next((c for c in NAMED if c in cleaned.columns), None)
    if place is not None and "CountryISO" in cleaned.columns:
        parts.append(_per_item(cleaned, "name_unmatched", F.col(place),
                               F.col("CountryISO").isNull()))
    rules = quality_report(name, raw)
    if rules is not None:
        parts.append(rules.select(F.lit("rule").alias("check"), F.col("rule").alias("item"),
                                  F.col("violations").alias("n")))
    return union_all(*parts).select(F.lit(name.lower()).alias("dataset"), "check", "item", "n")


def missing_values(name: str, cleaned: DataFrame) -> DataFrame:
    """Missing values per column of a cleaned dataset, zeros included, as lines of an audit."""
    profile = null_profile(cleaned, *[c for c in cleaned.columns if c != dedup.ORDINAL])
    return profile.select(F.lit(name.lower()).alias("dataset"), F.lit("nulls").alias("check"),
                          F.col("column").alias("item"), F.col("nulls").alias("n"))


def flow_audit(raw: dict[str, DataFrame], cleaned: dict[str, DataFrame]) -> DataFrame:
    """Audits of all datasets; ``cleaned`` is keyed by the lower-cased names of ``raw``."""
    return union_all(*[dataset_audit(n, df, cleaned[n.lower()]) for n, df in raw.items()])
