"""Read-side queries of the dashboards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.functions.dates import iso_instant
from terravane.operators import aggregates, columns, ranking


def city_ranking(counters: DataFrame, city: str = "city") -> DataFrame:
    """position, medal, city, score by positive - negative, ties by name."""
    scored = columns.add_missing(counters, positive="bigint", negative="bigint").select(
        F.col(city).alias("city"), ranking.net_score().alias("score"))
    order = [F.desc("score"), F.col("city")]
    ranked = ranking.number_rows(scored, order)
    return ranked.select("position", ranking.medal(F.col("position")).alias("medal"),
                         "city", "score")


def latest_posts(enriched: DataFrame, n: int = 10) -> DataFrame:
    """The newest enriched posts by their parsed time."""
    posts = enriched.withColumn("created_at", iso_instant("created_at"))
    newest = ranking.latest(posts, "created_at", n, F.col("city"), F.col("text"))
    return newest.select("created_at", "city", "assessment", "score", "text")


def table_explorer(df: DataFrame, n: int = 10,
                   order_by: Sequence | None = None) -> tuple[DataFrame, DataFrame]:
    """(row and column count, first rows)."""
    return aggregates.table_shape(df), ranking.head(df, n, order_by)


def numeric_explorer(df: DataFrame, view: str | None = None, x: str | None = None,
                     y: str | None = None, bins: int = 30,
                     fraction: float | None = None) -> DataFrame | None:
    """Data behind a chart of numeric columns: ``"scatter"`` or ``"histogram"``.

    The default is a scatter of the first two numeric columns, a histogram if there is
    only one, and nothing if there is none.
    """
    available = columns.numeric_columns(df)
    if not available or view == "none":
        return None
    view = view or ("scatter" if len(available) >= 2 else "histogram")
    if view == "histogram":
        return aggregates.histogram(df, x or available[0], bins)
    return columns.coordinate_pair(df, x, y, fraction)
