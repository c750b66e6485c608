"""Running counters per (city, label) that survive restarts and replays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terravane.fixed_values import COUNTERS
from terravane.operators.aggregates import counter_of
from terravane.staging import drop_versions, finished_versions


class CounterLog:
    """Counter totals stored as an append-only log, one partition per micro-batch.

    The streaming aggregation keeps the totals in its state store. Each micro-batch
    writes only the totals that changed, into a folder named after the batch. A batch
    that is replayed overwrites its own folder, so nothing is counted twice, and the
    current total of a key is its entry in the latest batch. Every ``fold_every``
    batches the latest totals are also written in one piece and older changes are
    deleted, so the log stays short.
    """

    def __init__(self, path: str, key: str = "city", label: str = "assessment",
                 fold_every: int = 100):
        self.path = path.rstrip("/")
        self.key = key
        self.label = label
        self.fold_every = fold_every

    def totals(self, df: DataFrame, counter: Column | None = None) -> DataFrame:
        """Long-form totals, batch or streaming."""
        counter = counter_of(self.label) if counter is None else counter
        return (df.groupBy(F.col(self.key), counter.alias("counter"))
                .agg(F.count(F.lit(1)).alias("n")))

    def write_batch(self, changed: DataFrame, batch_id: int) -> None:
        spark = changed.sparkSession
        changed.write.mode("overwrite").parquet(f"{self.path}/changes/batch_id={batch_id}")
        folds = finished_versions(spark, f"{self.path}/totals", "upto")
        last = folds[-1] if folds else 0
        if batch_id - last >= self.fold_every:
            self.current_long(spark).write.mode("overwrite").parquet(
                f"{self.path}/totals/upto={batch_id}")
            # What the fold before covers is kept up to here for readers already at work.
            drop_versions(spark, f"{self.path}/changes", "batch_id", last if folds else -1)
            drop_versions(spark, f"{self.path}/totals", "upto", last - 1)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None,
              counter: Column | None = None, name: str | None = "count_labels") -> StreamingQuery:
        writer = (self.totals(stream, counter).writeStream.outputMode("update")
                  .option("checkpointLocation", checkpoint)
                  .foreachBatch(self.write_batch))
        writer = writer.queryName(name) if name else writer
        return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()

    def current_long(self, spark: SparkSession) -> DataFrame:
        if not finished_versions(spark, f"{self.path}/changes", "batch_id"):
            return spark.createDataFrame([], f"{self.key} string, counter string, n bigint")
        changes = spark.read.parquet(f"{self.path}/changes").select(
            self.key, "counter", "n", F.col("batch_id").cast("bigint").alias("_batch"))
        folds = finished_versions(spark, f"{self.path}/totals", "upto")
        if folds:
            total = spark.read.parquet(f"{self.path}/totals/upto={folds[-1]}").select(
                self.key, "counter", "n", F.lit(folds[-1]).cast("bigint").alias("_batch"))
            changes = changes.filter(F.col("_batch") > folds[-1]).unionByName(total)
        return (changes.groupBy(self.key, "counter").agg(F.max_by("n", "_batch").alias("n")))

    def current(self, spark: SparkSession) -> DataFrame:
        """One row per city with positive, negative and neutral, 0 where never counted."""
        wide = self.current_long(spark).groupBy(self.key).pivot("counter", COUNTERS)
        return wide.agg(F.max("n")).na.fill(0)
