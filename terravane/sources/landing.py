"""Landing zone: one folder per table below a root path.

CSV files land with every column as text. Each row gets an ``_ordinal`` column: the
file, the position of the split inside it and the row number inside the split. It is
taken directly at the scan and stored, so "first row" keeps its meaning after any
shuffle.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.functions.names import sanitize_columns
from terravane.operators.dedup import ORDINAL

log = logging.getLogger(__name__)


class EmptyZoneError(ValueError):
    """The zone does not exist or holds no table."""


def with_ordinal(scan: DataFrame) -> DataFrame:
    """Add ``_ordinal`` to a file scan. Call it before any other operator."""
    return scan.withColumn(ORDINAL, F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ))


def read_csv(spark: SparkSession, path: str | Sequence[str],
             schema: T.StructType | None = None, ordinal: bool = True,
             on_clash: str = "fail") -> DataFrame:
    """CSV with a header row. All columns are text unless a schema is given.

    Several paths are read as one table, matched by column name; a column that a part lacks
    is NULL there. Column names are sanitised for landing.
    """
    if not isinstance(path, str) and len(path) > 1:
        parts = [read_csv(spark, p, schema, ordinal, on_clash) for p in path]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part, allowMissingColumns=True)
        names = [c for c in whole.columns if c != ORDINAL]
        return whole.select(*names, *([ORDINAL] if ordinal else []))
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader
    scan = reader.csv(path if isinstance(path, str) else list(path))
    data = sanitize_columns(scan, on_clash).columns
    if not ordinal:
        return scan.toDF(*data)
    return with_ordinal(scan).toDF(*data, ORDINAL)


def write_table(df: DataFrame, root: str, name: str, mode: str = "overwrite",
                file_format: str = "parquet") -> str:
    path = f"{root.rstrip('/')}/{name}"
    df.write.mode(mode).format(file_format).save(path)
    return path


def land_csv(spark: SparkSession, csv_path: str | Sequence[str], root: str, name: str,
             **options) -> str:
    return write_table(read_csv(spark, csv_path, **options), root, name)


def _folders(spark: SparkSession, root: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise EmptyZoneError(f"landing zone {root} does not exist")
    return [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]


def _is_table(spark: SparkSession, folder) -> bool:
    """A table folder holds the marker of a finished write, or a Delta log."""
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    return fs.exists(new_path(folder, "_SUCCESS")) or fs.exists(new_path(folder, "_delta_log"))


def read_zone(spark: SparkSession, root: str,
              file_format: str = "parquet") -> tuple[dict[str, DataFrame], dict[str, str]]:
    """(table name -> lazy frame, table name -> why it could not be read).

    Folders that are no table are skipped, a table that fails does not stop the
    others. A zone without any readable table is an error.
    """
    tables, failed = {}, {}
    for folder in sorted(_folders(spark, root), key=lambda p: p.getName()):
        name = folder.getName()
        if not _is_table(spark, folder):
            log.info("skipping %s: not a table", name)
            continue
        try:
            tables[name] = spark.read.format(file_format).load(folder.toString())
        except Exception as error:  # any unreadable table is reported, not raised
            log.warning("cannot read table %s: %s", name, error)
            failed[name] = str(error)
    if not tables:
        raise EmptyZoneError(f"landing zone {root} holds no readable table")
    return tables, failed


def read_zone_table(spark: SparkSession, root: str, name: str,
                    file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).load(f"{root.rstrip('/')}/{name}")


def compact(spark: SparkSession, source: str, target: str, target_file_mb: float = 256,
            file_format: str = "parquet") -> int:
    """Rewrite a table into fewer files at a fresh path; returns the file count asked for.

    Files of one partition folder (``name=value``) are merged with each other only, into as many
    files as its bytes need, so the table stays partitioned and no file is much larger than
    asked. Partitions are merged, not shuffled: the scan already packs small files together and
    ``coalesce`` joins neighbours, so no row crosses the network.
    """
    whole = spark.read.format(file_format).load(source)
    sizes = _folder_bytes(spark, source)
    names = [step.split("=")[0] for step in next(iter(sizes), "").split("/") if "=" in step]
    packed, files = None, 0
    for folder, size in sorted(sizes.items()):
        count = max(1, math.ceil(size / (target_file_mb * 1024 * 1024)))
        part = (spark.read.format(file_format).schema(whole.schema).option("basePath", source)
                .load(f"{source.rstrip('/')}/{folder}")).coalesce(count)
        packed, files = part if packed is None else packed.unionByName(part), files + count
    (whole if packed is None else packed).write.mode("errorifexists").partitionBy(*names).format(
        file_format).save(target)
    return files


def _folder_bytes(spark: SparkSession, source: str) -> dict[str, int]:
    """Bytes of the data files per folder below a table, by the folder's relative path."""
    root = spark._jvm.org.apache.hadoop.fs.Path(source)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    root = fs.makeQualified(root).toString().rstrip("/")
    found, sizes = fs.listFiles(spark._jvm.org.apache.hadoop.fs.Path(source), True), {}
    while found.hasNext():
        file = found.next()
        path = file.getPath().toString()[len(root):].lstrip("/")
        if not any(step.startswith(("_", ".")) and "=" not in step for step in path.split("/")):
            folder = path.rpartition("/")[0]
            sizes[folder] = sizes.get(folder, 0) + file.getLen()
    return sizes


def clear_zone(spark: SparkSession, root: str) -> list[str]:
    """Delete the table folders of one landing zone; other entries stay. Returns their names."""
    removed = []
    for folder in _folders(spark, root):
        if _is_table(spark, folder):
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
            removed.append(folder.getName())
    return sorted(removed)
