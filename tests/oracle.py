"""Runs a query in Spark and its SQL twin in DuckDB and compares the rows.

``python -m tests.oracle SF_DIR [name ...]`` checks from the command line.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(v):
    return round(v, 9) if isinstance(v, float) else v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[str, float, int]:
    """(problem or '', seconds in Spark, rows)"""
    began = time.time()
    df = query(spark, sf_dir)
    got = df.collect()
    took = time.time() - began
    result = con.execute(sql)
    wanted_columns = [d[0] for d in result.description]
    wanted = result.fetchall()
    if sorted(df.columns) != sorted(wanted_columns):
        return f"columns {sorted(df.columns)} != {sorted(wanted_columns)}", took, len(got)
    mine, theirs = rows_of(df.columns, got), rows_of(wanted_columns, wanted)
    if mine != theirs:
        extra = list((mine - theirs).items())[:2]
        absent = list((theirs - mine).items())[:2]
        return f"rows {len(got)} vs {len(wanted)}: extra {extra} absent {absent}", took, len(got)
    mine_types = {c: _kind(t) for c, t in df.dtypes}
    theirs_types = {d[0]: _kind(str(d[1])) for d in result.description}
    differing = {c: (mine_types[c], theirs_types[c]) for c in mine_types
                 if mine_types[c] != theirs_types[c]}
    return f"note: types {differing}" if differing else "", took, len(got)


_KINDS = {"bigint": "long", "BIGINT": "long", "int": "int", "INTEGER": "int", "double": "double",
          "DOUBLE": "double", "float": "float", "FLOAT": "float", "string": "text",
          "VARCHAR": "text", "date": "date", "DATE": "date", "timestamp_ntz": "time",
          "TIMESTAMP": "time", "timestamp": "time-zoned", "boolean": "bool", "BOOLEAN": "bool"}


def _kind(t: str) -> str:
    return _KINDS.get(t, t)


def session():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").appName("checks")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


if __name__ == "__main__":
    import __spark_entry__ as contract

    folder, wanted_names = sys.argv[1], sys.argv[2:]
    spark, con = session(), connect(folder)
    sqls, bad = contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if wanted_names and name not in wanted_names:
            continue
        try:
            problem, took, n = compare(spark, con, name, query, sqls[name], folder)
        except Exception as error:
            problem, took, n = f"{type(error).__name__}: {str(error)[:600]}", 0.0, -1
        bad += bool(problem) and not problem.startswith("note")
        print(f"{'ok ' if not problem else 'BAD' if not problem.startswith('note') else 'ok~'} "
              f"{name:28s} rows={n:<8d} {took:6.2f}s {problem}", flush=True)
    print(f"{bad} bad")
