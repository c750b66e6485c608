"""Which cleaning plan belongs to which dataset name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from terravane.plans import cleaning

# Lower-cased name prefix -> plan, tried in this order.
PLANS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "air_quality_index": cleaning.clean_air_quality_index,
    "current_air_quality_data": cleaning.clean_current_air_quality,
    "historical_weather": cleaning.clean_historical_weather,
    "globalenvironmental": cleaning.clean_environment_trends,
    "globallandtemperaturesby": cleaning.clean_city_land_temperature,
    "natural_disaster": cleaning.clean_natural_disasters,
    "world": cleaning.clean_happiness,
}


def plan_for(name: str, plans: dict[str, Callable] | None = None) -> Callable | None:
    name = name.lower()
    return next((p for prefix, p in (plans or PLANS).items() if name.startswith(prefix)), None)


def clean_all(tables: dict[str, DataFrame],
              plans: dict[str, Callable] | None = None) -> dict[str, DataFrame]:
    """Clean every table by its name; a table without a plan passes through unchanged.

    Result names are lower-cased.
    """
    cleaned = {}
    for name, df in tables.items():
        plan = plan_for(name, plans)
        cleaned[name.lower()] = plan(df) if plan else df
    return cleaned
