"""Report-only quality checks of raw datasets: how many rows break which rule.

The rules look at the raw columns and parse them on the way, so a report is one scan and
one aggregation whatever the number of rules. Counts refer to the rows as landed, before
any of them is removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terravane import fixed_values as fixed
from terravane.functions import dates, numbers
from terravane.operators import aggregates, columns
from terravane.plans import cleaning


def _number(df: DataFrame, name: str) -> Column:
    return numbers.as_number(name, df.schema[name].dataType)


def _outside(value: Column, bounds: tuple) -> Column:
    """Outside the closed interval; a missing value counts as outside."""
    return ~F.coalesce(numbers.let(value, lambda x: x.between(*bounds)), F.lit(False))


def _unparsed_date(df: DataFrame, name: str, date_format: str) -> Column:
    return dates.as_timestamp(name, df.schema[name].dataType, date_format).isNull()


def weather_rules(df: DataFrame) -> dict[str, Column]:
    rules = {}
    if "date" in df.columns:
        rules["date_unparsed"] = _unparsed_date(df, "date", dates.DATE_TIME_FORMAT)
    if "AverageTemperatureUncertainty" in df.columns:
        rules["uncertainty_negative"] = _number(df, "AverageTemperatureUncertainty") < 0
    if "AverageTemperature" in df.columns:
        rules["temperature_below_absolute_zero"] = (
            _number(df, "AverageTemperature") < fixed.ABSOLUTE_ZERO_CELSIUS)
    for name, bounds in (("latitude", fixed.LATITUDE_RANGE), ("longitude", fixed.LONGITUDE_RANGE)):
        if name in df.columns:
            rules[f"{name}_outside_range"] = _outside(_number(df, name), bounds)
    return rules


def land_temperature_rules(df: DataFrame) -> dict[str, Column]:
    at = {"latitude": numbers.latitude("Latitude"), "longitude": numbers.longitude("Longitude")}
    bounds = {"latitude": fixed.LATITUDE_RANGE, "longitude": fixed.LONGITUDE_RANGE}
    return {
        "date_unparsed": _unparsed_date(df, "dt", dates.DATE_TIME_FORMAT),
        **{f"{n}_unparsed": c.isNull() for n, c in at.items()},
        **{f"{n}_outside_range": _beyond(c, bounds[n]) for n, c in at.items()},
        "temperature_outside_range": _outside(
            _number(df, "AverageTemperature"), fixed.SURFACE_TEMPERATURE_RANGE),
        "uncertainty_negative": _number(df, "AverageTemperatureUncertainty") < 0,
    }


def _beyond(value: Column, bounds: tuple) -> Column:
    """Outside the closed interval; a missing value is no violation."""
    return numbers.let(value, lambda x: ~x.between(*bounds))


def trend_rules(df: DataFrame) -> dict[str, Column]:
    named = columns.present(df, "Year", *cleaning.TREND_COLUMNS.values())
    return {f"{n}_not_numeric": _number(df, n).isNull() for n in named}


def disaster_rules(df: DataFrame) -> dict[str, Column]:
    """Rules on a frame whose columns have been given their clean names."""
    rules = {f"{n}_negative": _number(df, n) < 0
             for n in columns.present(df, *cleaning.DISASTER_COUNTS)}
    parts = ("year", "month", "day")
    if all(f"{side}_{part}" in df.columns for side in ("start", "end") for part in parts):
        start, end = (dates.date_from_parts(*[F.col(f"{side}_{p}") for p in parts])
                      for side in ("start", "end"))
        rules["start_after_end"] = start > end
    return rules


# Lower-cased name prefix -> rules of the raw dataset.
RULES: dict[str, Callable[[DataFrame], dict[str, Column]]] = {
    "historical_weather": weather_rules,
    "globalenvironmental": trend_rules,
    "globallandtemperaturesby": land_temperature_rules,
    "natural_disaster": disaster_rules,
    "world": cleaning.happiness_rules,
}


def quality_report(name: str, df: DataFrame) -> DataFrame | None:
    """dataset, rule, violations, rows of a raw dataset; None if it has no rules."""
    name = name.lower()
    rules_of = next((r for prefix, r in RULES.items() if name.startswith(prefix)), None)
    if rules_of is None:
        return None
    if rules_of in (disaster_rules, cleaning.happiness_rules):
        df = cleaning.parsed_names(df)
    if rules_of is cleaning.happiness_rules:
        df = columns.to_numbers(df, *fixed.HAPPINESS_NUMERIC)
    rules = rules_of(df)
    return aggregates.rule_report(df, rules, name) if rules else None
