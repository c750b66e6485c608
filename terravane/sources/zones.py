"""Trusted and exploitation zones: databases of the session catalog."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.operators.dedup import ORDINAL
from terravane.operators.ranking import head
from terravane.operators.tables import upsert as upsert_rows
from terravane.sources.landing import EmptyZoneError


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def create_zone(spark: SparkSession, zone: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(zone)}{place}")


def save_table(df: DataFrame, zone: str, name: str, mode: str = "overwrite",
               partition_by: Sequence[str] = ()) -> None:
    """Write one table. ``overwrite`` replaces it, ``ignore`` creates it only if absent."""
    data = df.drop(ORDINAL)
    data.write.mode(mode).partitionBy(*partition_by).saveAsTable(_quoted(zone, name))


def save_tables(tables: dict[str, DataFrame], zone: str, mode: str = "overwrite") -> None:
    if not tables:
        raise ValueError("no tables to save")
    for name, df in tables.items():
        save_table(df, zone, name, mode)


#: Ends of the names of tables that a running or interrupted merge keeps next to its table.
_MERGE_ENDS = ("__merging", "__merged", "__touched")


def table_names(spark: SparkSession, zone: str) -> list[str]:
    """Tables of the zone, without what an interrupted merge left next to one of them."""
    names = sorted(t.name for t in spark.catalog.listTables(zone) if not t.isTemporary)
    return [n for n in names if not any(n.endswith(e) and n.removesuffix(e) in names for e in _MERGE_ENDS)]


def read_tables(spark: SparkSession, zone: str) -> dict[str, DataFrame]:
    """Every table of the zone as a lazy frame."""
    names = table_names(spark, zone)
    if not names:
        raise EmptyZoneError(f"zone {zone} holds no table")
    return {n: spark.table(_quoted(zone, n)) for n in names}


def zone_shapes(spark: SparkSession, zone: str) -> DataFrame:
    """table, rows, columns of each table; counts run inside the result's own job."""
    shapes = None
    for name, df in read_tables(spark, zone).items():
        one = df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
                     F.lit(len(df.columns)).alias("columns"))
        shapes = one if shapes is None else shapes.unionByName(one)
    return shapes


def zone_heads(spark: SparkSession, zone: str, n: int = 10) -> dict[str, DataFrame]:
    return {name: head(df, n) for name, df in read_tables(spark, zone).items()}


def reset_zone(spark: SparkSession, zone: str) -> list[str]:
    """Drop every table of the named zone, also what merges left; returns the tables' names."""
    names = table_names(spark, zone)
    for t in spark.catalog.listTables(zone):
        if not t.isTemporary:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(zone, t.name)}")
    return names


def upsert_table(source: DataFrame, zone: str, name: str, keys: Sequence[str]) -> None:
    """Merge rows into a table: matches are replaced, the rest is added.

    Of a partitioned table only the partitions that hold a matching key or get a row are read
    whole and written; the files of all others stay as they are. A partition that loses its last
    row is dropped. A table without partitions is rewritten as a whole.

    The merged rows are written under a name of their own first, as a table cannot be
    overwritten while it is read, and then replace the table's rows; definition and
    partitioning stay. Merged rows that a crash left behind are whole, as they get their
    name last: the next call puts them in place before its own.
    """
    spark = source.sparkSession
    table = _quoted(zone, name)
    merging, merged, touched = (_quoted(zone, name + end) for end in _MERGE_ENDS)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]

    if spark.catalog.tableExists(merged):
        _put_in_place(spark, table, merged, touched, parts)
    target = spark.table(table)
    if parts:
        moved = _touched_partitions(target, source, keys, parts)
        if not moved:
            return
        spark.createDataFrame(moved, target.select(*parts).schema).write.mode("overwrite").saveAsTable(touched)
        target = target.filter(_in_partitions(moved, parts))
    upsert_rows(target, source, keys).write.mode("overwrite").saveAsTable(merging)
    spark.sql(f"ALTER TABLE {merging} RENAME TO {merged}")
    _put_in_place(spark, table, merged, touched, parts)


def _touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str],
                        parts: list[str]) -> list[tuple]:
    """Partition values of the rows that a merge replaces or adds: at most one row per partition."""
    wanted = source.select(*keys).dropna("any")
    old = target.select(*parts, *[k for k in keys if k not in parts]).join(wanted, list(keys), "left_semi")
    kinds = [target.schema[p].dataType for p in parts]
    new = source.select(*[F.col(p).cast(kind).alias(p) for p, kind in zip(parts, kinds, strict=True)])
    return [tuple(r) for r in old.select(*parts).union(new).distinct().collect()]


def _in_partitions(values: list[tuple], parts: list[str]) -> Column:
    """Condition on partition columns alone, so that the scan lists only these partitions."""
    def one(row: tuple) -> Column:
        return reduce(lambda a, b: a & b, [
            F.col(p).isNull() if v is None else F.col(p) == F.lit(v) for p, v in zip(parts, row, strict=True)])

    plain = [r[0] for r in values if r[0] is not None]
    if len(parts) == 1 and plain:
        listed = F.col(parts[0]).isin(plain)
        return listed | F.col(parts[0]).isNull() if len(plain) < len(values) else listed
    return reduce(lambda a, b: a | b, [one(r) for r in values])


def _put_in_place(spark: SparkSession, table: str, merged: str, touched: str, parts: list[str]) -> None:
    """Replace the touched partitions, or all rows, by the merged ones; can be repeated."""
    rows = spark.table(merged).select(*spark.table(table).columns)
    conf, key = spark.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(key)
    conf.set(key, "dynamic" if parts else "static")
    try:
        rows.write.mode("overwrite").insertInto(table)
    finally:
        conf.set(key, before)
    if parts and spark.catalog.tableExists(touched):
        same = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts]
        filled = rows.select(*parts).distinct().toDF(*[f"_{p}" for p in parts])
        for r in spark.table(touched).join(filled, same, "left_anti").collect():
            spec = ", ".join(f"{_quoted(p)} = {_literal(r[p])}" for p in parts)
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    spark.sql(f"DROP TABLE {merged}")
    spark.sql(f"DROP TABLE IF EXISTS {touched}")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return str(value) if isinstance(value, int) else f"'{text}'"
