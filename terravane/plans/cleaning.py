"""One cleaning plan per dataset: raw landed frame in, trusted frame out.

All plans are lazy and keep NULL for missing values. Only the columns of a
de-duplication key are parsed before it, the others afterwards on the rows that are left. ``order_by`` gives the row order
that "keep the first row" refers to; by default it is the landed ordinal.
De-duplication comes before the validity filters on purpose: an invalid first row
removes its whole key.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane import fixed_values as fixed
from terravane.functions import dates, names, numbers, strings
from terravane.operators import columns, dedup, filters, joins, medians


def _need(df: DataFrame, *required: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def _stamp(df: DataFrame, source: str, target: str, *formats: str) -> DataFrame:
    """Add the parsed timestamp and its year."""
    parsed = dates.as_timestamp(source, df.schema[source].dataType, *formats)
    return df.withColumn(target, parsed).withColumn("Year", F.year(target))


def _without_order(df: DataFrame, had_ordinal: bool) -> DataFrame:
    return df if had_ordinal else df.drop(dedup.ORDINAL)


def parsed_names(df: DataFrame) -> DataFrame:
    """Column names in the form the happiness and disaster plans use."""
    df = names.snake_case_columns(df.drop(dedup.ORDINAL))
    return columns.rename_present(df, {"country_name": "country"})


def clean_current_air_quality(df: DataFrame, order_by: Sequence | None = None,
                              date_format: str = dates.DATE_FORMAT) -> DataFrame:
    """Station readings: code, date, numbers, first reading per city and day, valid only."""
    measures = ["aqi", "pm25", "pm10", "no2"]
    _need(df, "city", "date", *measures)
    had_ordinal = dedup.ORDINAL in df.columns
    df, order = dedup.with_row_order(df, order_by)
    df = df.withColumn("city", strings.strip("city"))
    df = _stamp(df, "date", "DateTime", date_format)
    df = dedup.keep_first(df, ["city", "DateTime"], order)
    # "-" is no number, so the lenient cast covers the sentinel as well.
    df = columns.to_numbers(df, *measures)
    df = filters.keep_non_negative(df, *measures)
    df = joins.add_city_code(df.drop("date").withColumnRenamed("city", "City"), "City")
    return _without_order(df, had_ordinal)


def clean_historical_weather(df: DataFrame, order_by: Sequence | None = None,
                             date_format: str = dates.DATE_TIME_FORMAT) -> DataFrame:
    """Daily weather per city. Impossible values become NULL, rows stay."""
    _need(df, "city")
    had_ordinal = dedup.ORDINAL in df.columns
    df, order = dedup.with_row_order(df, order_by)
    df = columns.transform_present(df, strings.strip, "city", "Country")
    if "date" in df.columns:
        df = _stamp(df, "date", "DateTime", date_format)
    else:
        df = columns.add_missing(df, DateTime="timestamp", Year="int")
    # The country code follows from the city, so it adds nothing to the key.
    df = dedup.keep_first(df, ["DateTime", "city"], order)
    df = columns.rename_present(df, {"latitude": "Latitude", "longitude": "Longitude"})
    df = columns.to_numbers(
        df, "AverageTemperature", "AverageTemperatureUncertainty", "Latitude", "Longitude")
    df = columns.transform_present(
        df, lambda c: numbers.null_below(c, 0), "AverageTemperatureUncertainty")
    df = columns.transform_present(
        df, lambda c: numbers.null_below(c, fixed.ABSOLUTE_ZERO_CELSIUS), "AverageTemperature")
    df = columns.transform_present(
        df, lambda c: numbers.null_outside(c, fixed.LATITUDE_RANGE), "Latitude")
    df = columns.transform_present(
        df, lambda c: numbers.null_outside(c, fixed.LONGITUDE_RANGE), "Longitude")
    df = joins.add_city_code(df.drop("date").withColumnRenamed("city", "City"), "City")
    return _without_order(df, had_ordinal)


TREND_COLUMNS = {
    "temperature": "Avg_Temperature_degC",
    "co2": "CO2_Emissions_tons_per_capita",
    "sea_level": "Sea_Level_Rise_mm",
    "rainfall": "Rainfall_mm",
    "population": "Population",
    "renewable": "Renewable_Energy_pct",
    "events": "Extreme_Weather_Events",
    "forest": "Forest_Area_pct",
}


def clean_environment_trends(df: DataFrame, order_by: Sequence | None = None,
                             names_of: dict[str, str] | None = None,
                             dedup_fallback_key: str | None = None) -> DataFrame:
    """Yearly country indicators.

    Only listed countries have a code, so all others share the NULL key per year and
    one of their rows survives. ``dedup_fallback_key="Country"`` keeps them apart.
    """
    col = TREND_COLUMNS | (names_of or {})
    _need(df, "Year", "Country")
    had_ordinal = dedup.ORDINAL in df.columns
    df, order = dedup.with_row_order(df, order_by)
    df = df.withColumn("Country", strings.strip_quotes(strings.strip("Country")))
    df = joins.add_listed_country_code(df, "Country")
    df = columns.to_whole_numbers(df, "Year")
    key = F.col("CountryISO")
    if dedup_fallback_key:
        key = F.coalesce(key, F.concat(F.lit("name:"), F.col(dedup_fallback_key)))
    df = dedup.keep_first(df, ["Year", key], order)
    df = columns.to_whole_numbers(df, col["population"], col["events"])
    df = columns.to_numbers(df, col["temperature"], col["co2"], col["sea_level"],
                            col["rainfall"], col["renewable"], col["forest"])
    df = columns.transform_present(
        df, lambda c: numbers.null_below(c, fixed.ABSOLUTE_ZERO_CELSIUS), col["temperature"])
    df = columns.transform_present(
        df, lambda c: numbers.null_below(c, 0), col["co2"], col["sea_level"],
        col["rainfall"], col["population"], col["events"])
    df = columns.transform_present(
        df, lambda c: numbers.null_outside(c, fixed.PERCENT_RANGE),
        col["renewable"], col["forest"])
    bounds = {
        col["temperature"]: fixed.SURFACE_TEMPERATURE_RANGE,
        col["forest"]: fixed.PERCENT_RANGE,
        col["renewable"]: fixed.PERCENT_RANGE,
        col["population"]: fixed.POPULATION_RANGE,
        col["rainfall"]: (0.0, float("inf")),
    }
    bounds = {n: b for n, b in bounds.items() if n in df.columns}
    df = filters.keep_between(df, **bounds) if bounds else df
    return _without_order(df, had_ordinal)


def clean_city_land_temperature(df: DataFrame, order_by: Sequence | None = None,
                                date_format: str = dates.DATE_TIME_FORMAT,
                                listed_codes: bool = False) -> DataFrame:
    """Monthly land temperature per major city.

    ``listed_codes`` takes the code from the short country list instead of the register,
    by the lower-cased name; as the list has no lower-case names the code stays missing.

    Full-row duplicates need no pass of their own: rows that are equal share the key,
    so keeping the first row per key removes them too.
    """
    _need(df, "dt", "City", "Country", "Latitude", "Longitude",
          "AverageTemperature", "AverageTemperatureUncertainty")
    had_ordinal = dedup.ORDINAL in df.columns
    df, order = dedup.with_row_order(df, order_by)
    df = dedup.keep_first(df, ["dt", "City", "Country"], order)
    df = _stamp(df, "dt", "DateTime", date_format)
    df = columns.to_numbers(df, "AverageTemperature", "AverageTemperatureUncertainty")
    df = df.withColumns({"Latitude": numbers.latitude("Latitude"),
                         "Longitude": numbers.longitude("Longitude")})
    df = filters.keep_complete(df, "DateTime", "Latitude", "Longitude")
    df = df.withColumns({
        "AverageTemperature": numbers.null_outside(
            "AverageTemperature", fixed.SURFACE_TEMPERATURE_RANGE),
        "AverageTemperatureUncertainty": numbers.null_below("AverageTemperatureUncertainty", 0),
    })
    df = filters.keep_between(
        df, Latitude=fixed.LATITUDE_RANGE, Longitude=fixed.LONGITUDE_RANGE)
    if listed_codes:
        df = df.withColumn("Country", strings.strip_lower("Country"))
        df = joins.add_listed_country_code(df, "Country")
    else:
        df = joins.add_country_code(df, "Country")
    df = columns.to_float32(df)
    df = df.withColumns({c: strings.title_case(strings.strip(c)) for c in ("City", "Country")})
    return _without_order(df.drop("dt"), had_ordinal)


def clean_happiness(df: DataFrame, exact: bool = True) -> DataFrame:
    """Happiness scores per country: codes, median imputation, Kosovo removed last.

    The medians are taken over all rows, before the exclusion.
    """
    df = dedup.distinct_rows(parsed_names(df))
    df = columns.to_numbers(df, *fixed.HAPPINESS_NUMERIC)
    fractions = columns.columns_of_type(df, T.DoubleType, T.FloatType)
    df = medians.impute_medians(df, *columns.numeric_columns(df), exact=exact)
    df = columns.to_float32(df, *fractions) if fractions else df
    if "country" in df.columns:
        df = filters.exclude_entity(df, "country", "kosovo", strings.strip_lower)
        df = joins.add_country_code(df, "country")
    return columns.move_first(df, "country", "CountryISO")


def happiness_rules(df: DataFrame) -> dict:
    """Report-only checks on a cleaned happiness frame."""
    rules = {}
    if "ladder_score" in df.columns:
        rules["ladder_score_outside_range"] = ~F.col("ladder_score").between(*fixed.LADDER_RANGE)
    for low, high in (("lowerwhisker", "upperwhisker"), ("lower_whisker", "upper_whisker")):
        if low in df.columns and high in df.columns:
            rules["whiskers_crossed"] = F.col(low) > F.col(high)
            if "ladder_score" in df.columns:
                rules["score_outside_whiskers"] = ~F.col("ladder_score").between(
                    F.col(low), F.col(high))
            break
    return rules


DISASTER_TEXT = ["disaster_type", "disaster_subtype", "country", "region", "location",
                 "event_name"]
DISASTER_COUNTS = ["total_deaths", "no_injured", "no_affected", "no_homeless", "total_affected"]
DISASTER_COSTS = ["reconstruction_costs_usd", "insured_damages_usd", "total_damages_usd"]


def clean_natural_disasters(df: DataFrame, end_mode: str = "start",
                            cost_columns: Sequence[str] = tuple(DISASTER_COSTS)) -> DataFrame:
    """Disaster events: normalised text, start and end dates, non-negative counts.

    With the default ``end_mode`` an end date without month or day is completed to the
    start of its period and then lifted to the start date; ``"end"`` completes it to
    the end of the period. Amounts stay double, as float would round them.
    """
    df = dedup.distinct_rows(names.snake_case_columns(df.drop(dedup.ORDINAL)))
    df = columns.transform_present(df, strings.normalize_text, *DISASTER_TEXT)
    for side, mode in (("start", "start"), ("end", end_mode)):
        if f"{side}_year" in df.columns:
            named = [f"{side}_{part}" for part in ("year", "month", "day")]
            parts = [F.col(n) if n in df.columns else F.lit(None).cast("string") for n in named]
            df = df.withColumn(f"{side.title()}Date", dates.date_from_parts(*parts, mode=mode))
    df = columns.to_numbers(df, *DISASTER_COUNTS, *cost_columns, "latitude", "longitude")
    df = columns.transform_present(df, lambda c: numbers.null_below(c, 0), *DISASTER_COUNTS)
    if {"StartDate", "EndDate"} <= set(df.columns):
        df = df.withColumn("EndDate", columns.repair_end(F.col("StartDate"), F.col("EndDate")))
    df = columns.to_float32(df, "latitude", "longitude")
    df = columns.rename_present(
        df, {"latitude": "Latitude", "longitude": "Longitude", "iso": "CountryISO"})
    return columns.move_last(df, "CountryISO")


def clean_air_quality_index(df: DataFrame, date_format: str = dates.DATE_FORMAT,
                            country_name: str = "Country",
                            strict_code: bool = False) -> DataFrame:
    """Dated air quality index per country.

    ``country_name`` renames the country column, ``strict_code`` drops codes that are
    not three upper-case letters. Text such as ``-`` or ``N/A`` is no number and its
    row is dropped, like negative values.
    """
    df = names.strip_column_names(df)
    value = names.find_column(df, "AQI Value", "aqi_value", "aqi")
    _need(df, "Country")
    df = columns.transform_present(
        df, strings.strip, "City", *filter(None, [names.find_column(df, "AQI Category")]))
    df = filters.exclude_entity(df, "Country", "Kosovo")
    if value:
        df = columns.to_numbers(df, value).withColumnRenamed(value, "aqi")
        df = filters.keep_non_negative(df, "aqi")
    if "Date" in df.columns:
        df = _stamp(df, "Date", "DateTime", date_format).drop("Date")
    else:
        df = columns.add_missing(df, DateTime="timestamp", Year="int")
    df = joins.add_country_code(df, "Country")
    if strict_code:
        df = df.withColumn("CountryISO", strings.iso_code_or_null("CountryISO"))
    return columns.rename_present(df, {"Country": country_name})


def clean_country_indicators(df: DataFrame, order_by: Sequence | None = None,
                             this_year: int | None = None, float32: bool = False) -> DataFrame:
    """Yearly development indicators per country, 1900 up to the current year.

    Header names are accepted in their raw and in their landed spelling. A table whose
    years are all missing is kept whole. ``float32`` stores the indicators as floats, which
    rounds large ones; ``audit.missing_values`` counts what is missing afterwards.
    """
    code, name = names.find_column(df, "Country Code"), names.find_column(df, "Country Name")
    if code is None or "Time" not in df.columns:
        raise ValueError("missing columns: need a country code and Time")
    had_ordinal = dedup.ORDINAL in df.columns
    df, order = dedup.with_row_order(df, order_by)
    # Checked on the raw scan, where it reads one column and stops at the first hit.
    year = numbers.as_number("Time", df.schema["Time"].dataType)
    has_year = df.select(year.alias("y")).filter(F.col("y").isNotNull()).limit(1).exists()
    df = dedup.keep_first(df, [F.col(f"`{code}`"), F.col("Time")], order)
    indicators = [n for n in map(lambda i: names.find_column(df, i), fixed.COUNTRY_INDICATORS) if n]
    renames = {code: "CountryISO", "Time": "Year"} | ({name: "CountryName"} if name else {})
    df = df.select(*[
        (numbers.as_number(F.col(f"`{c}`"), df.schema[c].dataType) if c in indicators
         else F.col(f"`{c}`")).alias(renames.get(c, c))
        for c in df.columns
    ])
    df = columns.to_whole_numbers(df, "Year")
    if name:
        df = filters.exclude_entity(df, "CountryName", "kosovo", strings.strip_lower)
    df = df.withColumn("CountryISO", F.upper("CountryISO"))
    last = this_year or date.today().year
    in_range = numbers.let(F.col("Year"), lambda y: y.between(1900, last))
    df = df.filter(F.coalesce(in_range, ~has_year))
    if float32:
        df = columns.to_float32(df, *indicators)
    return _without_order(df, had_ordinal)
