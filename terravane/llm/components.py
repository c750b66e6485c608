"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane import staging

#: Rows of a task, if that makes more tasks than cores; an edge is two, one for each direction.
EDGES_PER_TASK = 1 << 16


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of an edge list reaches.

    edges: left, right (any one orderable type; order, repeats and loops don't matter). Nodes
    without an edge to another node are not returned. Each round replaces every edge by edges
    to smaller nodes: first all larger neighbours of a node are linked to its smallest
    neighbour, then all smaller ones. It ends, after about log(longest path) rounds, when the
    edges are stars. A round only takes minima of groups, which combine before the shuffle,
    and joins them back, so a hub is never gathered. Rounds are cut by checkpoints.

    The number of edges bounds the tasks of a round, whatever the number of shuffle partitions: a few
    thousand edges in hundreds of partitions are nothing but small files, a dozen shuffles a round.
    """
    staging.enable_checkpoints(edges.sparkSession)
    cores = edges.sparkSession.sparkContext.defaultParallelism
    edges = edges.select("left", "right").where("left <> right").select(
        F.greatest("left", "right").alias("u"), F.least("left", "right").alias("v")
    ).distinct().checkpoint()
    digest = _digest(edges)
    while True:
        # no step makes more rows than both directions of all edges
        tasks = max(cores, -(-2 * digest[0] // EDGES_PER_TASK))
        edges = edges.coalesce(tasks)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")).coalesce(tasks)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").coalesce(tasks).distinct().coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        small = large.join(least, "u").coalesce(tasks)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).where("u <> v").distinct().coalesce(tasks)
        following = small.checkpoint()
        moved = _digest(following)
        # equal sizes and sums of hashes: nothing moved
        if moved == digest:
            return following.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges, digest = following, moved


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
