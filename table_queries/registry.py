"""Collects the queries of one module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Registry:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracle: dict[str, str] = {}

    def query(self, sql: str | None = None):
        """Register a function under its own name, with its SQL twin if there is one."""
        def add(fn):
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.oracle[fn.__name__] = sql
            return fn
        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
