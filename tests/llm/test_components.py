"""Tasks and results of the star rounds."""

from pyspark.sql import functions as F

from terravane.llm.components import EDGES_PER_TASK, components


def _tasks(spark, action):
    sc = spark.sparkContext
    sc.setJobGroup("star-rounds", "star rounds")
    try:
        out = action()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("star-rounds") for s in tracker.getJobInfo(j).stageIds}
    return out, sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s)))


def test_tasks_of_few_edges_do_not_follow_the_partitions(spark):
    """Chains of ten in many shuffle partitions: a round is a few tasks, not hundreds."""
    wide = 150
    settings = {"spark.sql.shuffle.partitions": str(wide), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(1000).where("id % 10 < 9").select(
            F.col("id").alias("left"), (F.col("id") + 1).alias("right"))
        rows, tasks = _tasks(spark, lambda: components(edges).collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {r.node: r.root for r in rows} == {i: i - i % 10 for i in range(1000) if i % 10}
    # the edges once in all partitions, then up to eight rounds of some twenty narrow stages
    assert tasks < 6 * wide + 8 * 20 * 2 * spark.sparkContext.defaultParallelism


def test_more_edges_than_a_task_holds(spark):
    """A hub and long chains beyond EDGES_PER_TASK: every node is there once, with its root."""
    size = EDGES_PER_TASK + 1000
    hub = spark.range(1, size).select(F.lit(0).cast("long").alias("left"), F.col("id").alias("right"))
    chain = spark.range(size, size + 500).select(F.col("id").alias("left"), (F.col("id") + 1).alias("right"))
    got = components(hub.union(chain)).groupBy("root").agg(F.count("*").alias("n"), F.countDistinct("node").alias("d"))
    assert {tuple(r) for r in got.collect()} == {(0, size - 1, size - 1), (size, 500, 500)}
