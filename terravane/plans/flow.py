"""Landing -> trusted -> exploitation as one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.operators.dedup import ORDINAL
from terravane.plans import marts
from terravane.plans.audit import AUDIT_TABLE, flow_audit
from terravane.plans.registry import clean_all, plan_for
from terravane.sources import zones
from terravane.sources.landing import read_zone, with_ordinal

# Lower-cased name prefix -> column whose ranges the marts read.
PARTITIONED = {"historical_weather": "Year", "air_quality_index": "Year"}


class IncompleteRun(RuntimeError):
    """Some landed tables could not be read: ``failed`` (table -> reason), ``built`` marts."""

    def __init__(self, failed: dict[str, str], built: list[str]):
        super().__init__(f"tables not read: {failed}; marts built: {built}")
        self.failed, self.built = failed, built


def _save(tables: dict[str, DataFrame], zone: str) -> None:
    """Write tables, those of ``PARTITIONED`` by year: in few files a year, whatever its size."""
    for name, df in tables.items():
        year = plan_for(name, PARTITIONED)
        if year in df.columns:
            zones.save_table(df.hint("rebalance", F.col(year)), zone, name, partition_by=[year])
        else:
            zones.save_table(df, zone, name)


def refresh_trusted(spark: SparkSession, landing_root: str, trusted: str,
                    file_format: str = "parquet", audit: bool = True) -> dict[str, str]:
    """Clean every landed table into the trusted zone; one job per table.

    Tables landed without an ordinal get one from their files. ``audit`` also writes the
    table ``flow_audit``. Returns the landed tables that could not be read, with the reason.
    """
    tables, failed = read_zone(spark, landing_root, file_format)
    tables = {n: df if ORDINAL in df.columns else with_ordinal(df) for n, df in tables.items()}
    zones.create_zone(spark, trusted)
    _save(clean_all(tables), trusted)
    if audit:
        saved = zones.read_tables(spark, trusted)
        zones.save_table(flow_audit(tables, saved), trusted, AUDIT_TABLE)
    return failed


def refresh_exploitation(spark: SparkSession, trusted: str, exploitation: str,
                         mart_mode: str = "ignore") -> list[str]:
    """Copy the trusted tables and build the marts.

    Marts are created once and left alone afterwards; ``mart_mode="overwrite"``
    refreshes them. A mart whose inputs are absent is left out. Returns the marts built.
    """
    tables = zones.read_tables(spark, trusted)
    tables.pop(AUDIT_TABLE, None)
    zones.create_zone(spark, exploitation)
    _save(tables, exploitation)
    recipes = {
        marts.AIR_HAPPINESS_MART: (
            marts.air_quality_happiness, "current_air_quality_data", "world_hapiness_scores"),
        marts.WEATHER_INDEX_MART: (
            marts.weather_air_index, "historical_weather", "air_quality_index"),
    }
    built = []
    for name, (recipe, left, right) in recipes.items():
        if left in tables and right in tables:
            zones.save_table(recipe(tables[left], tables[right]), exploitation, name, mart_mode)
            built.append(name)
    return built


def run_all(spark: SparkSession, landing_root: str, trusted: str = "trusted",
            exploitation: str = "exploitation", mart_mode: str = "ignore") -> list[str]:
    """Both steps over all readable tables; then fails if a landed table could not be read."""
    failed = refresh_trusted(spark, landing_root, trusted)
    built = refresh_exploitation(spark, trusted, exploitation, mart_mode)
    if failed:
        raise IncompleteRun(failed, built)
    return built
