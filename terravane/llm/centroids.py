"""K-means on integer vectors with an incremental distance matrix.

Every vector keeps its exact dot products with all centroids. When centroids move, a dot product
changes by the vector's product with the components of the centroid that changed, the others
are not touched; the squared distance is |v|^2 - 2 v.c + |c|^2, and its argmin the cluster. All
numbers are integers, so results don't depend on the order of the rows. The matrix is a table
that each round rewrites; only centroids and their sums, k rows, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane import staging

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
#: Components up to this keep every distance of 64 dimensions inside 64 bits.
LIMIT = 1 << 27
_STATE = "vec_id long, v array<int>, norm long, dots array<long>, cluster int, distance long"


def integer_vectors(vectors: DataFrame, *, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v, norm): vectors with `dimensions` components, none null or non-finite.

    Component x becomes floor(scale * x). A finite component that would be 2^27 or more in size
    is an error, since distances would pass 64 bits. Other columns are not read.
    """
    e = F.col("embedding").cast("array<double>")
    odd = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e"), (
        (F.size(e) == dimensions) & ~odd).alias("whole")).where("whole")

    def exact(x):
        y = F.floor(x * F.lit(float(scale)))
        return F.when(F.abs(x * F.lit(float(scale))) < LIMIT, y).otherwise(
            F.raise_error(F.lit(f"a component is {LIMIT} or more after scaling"))).cast("int")

    v = F.transform("e", exact)
    return kept.select("vec_id", v.alias("v")).withColumn("norm", F.aggregate(
        "v", F.lit(0).cast("long"), lambda s, x: s + x.cast("long") * x.cast("long")))


def first_centroids(kept: DataFrame, k: int = CENTROIDS, seed: int = 1) -> np.ndarray:
    """The k vectors with the smallest SHA-256 of `seed:vec_id`, in that order.

    Equal hashes (repeated vec_ids) are ordered by their components; vectors without a vec_id
    come last. At most k vectors reach the driver.
    """
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.select(order.alias("order"), "v").orderBy(F.col("order").asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def moved(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """The state after centroids moved from `old` to `new`."""
    changed = [np.flatnonzero(d) for d in new - old]
    steps = [(c, at, (new - old)[c, at]) for c, at in enumerate(changed) if len(at)]
    squares = (new * new).sum(axis=1)
    k, dimensions = new.shape

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v").flatten().to_numpy().reshape(-1, dimensions).astype(np.int64)
            dots = batch.column("dots").flatten().to_numpy().reshape(-1, k).copy()
            for c, at, step in steps:
                dots[:, c] += v[:, at] @ step
            distance = batch.column("norm").to_numpy()[:, None] - 2 * dots + squares
            cluster = distance.argmin(axis=1)  # the first of equal ones
            ends = pa.array(np.arange(0, dots.size + 1, k, dtype=np.int32))
            yield pa.record_batch({
                "vec_id": batch.column("vec_id"), "v": batch.column("v"), "norm": batch.column("norm"),
                "dots": pa.ListArray.from_arrays(ends, pa.array(dots.reshape(-1))),
                "cluster": pa.array(cluster.astype(np.int32)),
                "distance": pa.array(distance[np.arange(len(cluster)), cluster]),
            })

    return state.select("vec_id", "v", "norm", "dots").mapInArrow(update, _STATE)


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floors of the clusters' componentwise means; an empty one keeps its centroid."""
    dimensions = centroids.shape[1]
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *(
        F.sum(F.get("v", F.lit(i)).cast("long")).alias(f"s{i}") for i in range(dimensions))).collect()
    following = centroids.copy()
    for r in sums:  # one row per centroid; // of Python integers is an exact floor
        following[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(dimensions)]
    return following


def cluster(vectors: DataFrame, *, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            scale: int = SCALE, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, v, cluster, distance) of every kept vector, final centroids).

    Each round assigns every vector to its nearest centroid (ties: the smaller number) and moves
    the centroids; then vectors are assigned once more. Rounds after one that moves nothing are
    skipped, since they would repeat it. Fewer than k vectors give fewer centroids, no vector
    none. Repeated rows count as often as they occur.
    """
    spark = vectors.sparkSession

    def landed(df: DataFrame) -> DataFrame:
        path = staging.fresh_path(spark, "dot-products")
        df.write.parquet(path)
        return spark.read.parquet(path)

    kept = landed(integer_vectors(vectors, dimensions=dimensions, scale=scale))
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return kept.select("vec_id", "v", F.lit(0).alias("cluster"), "norm").withColumnRenamed(
            "norm", "distance"), np.zeros((0, dimensions), np.int64)
    start = np.zeros_like(centroids)  # with it all dot products are 0
    state = kept.withColumn("dots", F.array_repeat(F.lit(0).cast("long"), len(centroids)))
    state = landed(moved(state, start, centroids))
    for _ in range(rounds):
        following = means(state, centroids)
        if (following == centroids).all():
            break
        state = landed(moved(state, centroids, following))
        centroids = following
    return state.select("vec_id", "v", "cluster", "distance"), centroids


def report(vectors: DataFrame, **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of kept vectors."""
    found, centroids = cluster(vectors, **options)
    spark = vectors.sparkSession
    each = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    known = [(c, each.get(c, 0), sum(each.values()), hashlib.sha256(
        ",".join(str(int(x)) for x in row).encode()).hexdigest()) for c, row in enumerate(centroids)]
    known = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
