"""Where intermediate tables and checkpoints go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a scratch folder only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="terravane-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def enable_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a folder that is set already."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))


#: Paths handed out in this process and not dropped yet.
_handed_out: list[str] = []


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody else uses; ``drop_scratch`` deletes it."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def drop_scratch(spark: SparkSession) -> list[str]:
    """Delete what was written below the paths handed out so far; returns those that held anything.

    Results are lazy and read their intermediate tables when they run, so call this once they are
    written or collected. Results that are still needed fail afterwards.
    """
    dropped = []
    while _handed_out:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True):
            dropped.append(folder.toString())
    return dropped


def finished_versions(spark: SparkSession, path: str, label: str) -> list[int]:
    """Numbers N of the folders ``label=N`` below a path whose write was finished."""
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    pattern = new_path(f"{path}/{label}=*/_SUCCESS")
    fs = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(pattern) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def drop_versions(spark: SparkSession, path: str, label: str, upto: int) -> None:
    """Delete the folders ``label=N`` below a path with N at most ``upto``."""
    for version in finished_versions(spark, path, label):
        if version <= upto:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{label}={version}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
