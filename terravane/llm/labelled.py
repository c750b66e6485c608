"""Labelled rows: the held-out fold, a bounded training sample, a model fitted in one task."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

#: Labelled documents that a model is fitted on, at most; half of each class if there are.
TRAIN_ROWS = 8_000


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the doc_id as text leaves 1 by 3; labels of these are never read."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str,
                    rows: int = TRAIN_ROWS) -> DataFrame:
    """(text, y, weight): at most `rows` labelled documents outside the held-out fold.

    Of each class the documents with the smallest hashes are taken, up to half of the rows; only
    documents under a hash bound that leaves a few more than that are sorted.
    weight: labelled documents of the class for each one taken, so that the sample stands for
    all labelled ones. Null labels are no labels. A doc_id labelled several times counts once
    per different label. Of several documents with a labelled doc_id one is taken, by the hash
    of the text, so the bound holds whatever repeats.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(
        ~held_out(F.col("doc_id"))).select("doc_id", (F.col(label) > 0).cast("int").alias("y")).distinct()
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    code = F.xxhash64("doc_id")
    for y, n in sorted(sizes.items()):
        part = known.where((F.col("y") == y) & (code <= hash_bound(rows // 2, n))).orderBy(
            code, "doc_id").limit(rows // 2).withColumn("weight", F.lit(n / min(n, rows // 2)))
        chosen = part if chosen is None else chosen.unionByName(part)
    if chosen is None:
        chosen = known.withColumn("weight", F.lit(1.0))
    chosen = chosen.withColumnRenamed("doc_id", "_d")  # at most `rows` rows
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_d"))
    one = found.groupBy("_d", "y", "weight").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("t"))
    return one.select("t.text", "y", "weight")


def hash_bound(wanted: int, of: int) -> int:
    """A signed 64-bit bound with over `wanted` of `of` evenly spread hashes up to it.

    The margin is ten standard deviations and 20, so that too few are as good as impossible.
    """
    share = min(1.0, (wanted + 10 * math.sqrt(wanted) + 20) / max(of, 1))
    return min(int(share * 2**64) - 2**63, 2**63 - 1)


def fit_in_one_task(features: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes:
    """The model that `fit` makes of a bounded table, on an executor; only the model is returned.

    The rows come in the order of their values, so that equal tables give equal models.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = list(batches)
        if got:
            yield pa.record_batch({"model": pa.array([fit(pa.Table.from_batches(got))], pa.binary())})

    made = features.repartition(1).sortWithinPartitions(*features.columns).mapInArrow(run, "model binary").first()
    return fit(to_arrow_schema(features.schema).empty_table()) if made is None else made[0]
