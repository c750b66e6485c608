"""Shorthands for golden-row tests."""

from pyspark.sql import functions as F


def text_frame(spark, *rows, columns="t"):
    """A frame of text columns, numbered in row order."""
    names = columns.split()
    data = [(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)]
    schema = "_i int, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame(data, schema)


def apply(spark, expression, *rows, columns="t"):
    """Values of an expression over text rows, in row order."""
    df = text_frame(spark, *rows, columns=columns)
    return [r[0] for r in df.orderBy("_i").select(expression.alias("x")).collect()]


def rows(df, *order):
    df = df.orderBy(*order) if order else df
    return [tuple(r) for r in df.collect()]


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


__all__ = ["F", "apply", "frame", "plan", "rows", "text_frame"]
