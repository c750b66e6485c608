"""Joined marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.functions.dates import as_timestamp, year_between
from terravane.operators.dedup import ORDINAL
from terravane.operators.joins import inner_join

AIR_HAPPINESS_MART = "merged_airquality_happiness_2025"
WEATHER_INDEX_MART = "merged_hw_aq_2022_2025"
# Parts that the rows without a country code are dealt out to.
NULL_SALTS = 32


def air_quality_happiness(air: DataFrame, happiness: DataFrame, match_nulls: bool = True,
                          hot_share: float | None = None) -> DataFrame:
    """Current air quality with the happiness scores of the same country.

    Rows without a country code pair with each other unless ``match_nulls`` is off.
    """
    return inner_join(air.drop(ORDINAL), happiness.drop(ORDINAL), ["CountryISO"], match_nulls,
                      hot_share=hot_share, null_salts=NULL_SALTS)


def weather_air_index(weather: DataFrame, index: DataFrame, first_year: int = 2022,
                      last_year: int = 2025, match_nulls: bool = True,
                      hot_share: float | None = None) -> DataFrame:
    """Historical weather with the air quality index of the same country and moment.

    The year range is a timestamp range on both sides, so it reaches the scans, and also a
    range of ``Year``, which tables partitioned by it are pruned with.
    """
    def in_range(df: DataFrame) -> DataFrame:
        df = df.withColumn("DateTime", as_timestamp("DateTime", df.schema["DateTime"].dataType))
        df = df.filter(year_between("DateTime", first_year, last_year)).drop(ORDINAL)
        return df.filter(F.col("Year").between(first_year, last_year)) if "Year" in df.columns else df

    return inner_join(in_range(weather), in_range(index), ["CountryISO", "DateTime"],
                      match_nulls, hot_share=hot_share, null_salts=NULL_SALTS)
