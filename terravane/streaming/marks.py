"""High-water mark per author: pass on only posts newer than the last ones seen.

A poll (micro-batch) is compared with the marks as they were before it. Afterwards an
author's mark moves to the newest of that author's posts, whether or not it matched the
topic words. The marks are a log: a micro-batch adds the marks that it moved, and nothing for
the other authors. As marks only move forward, the mark of an author is the largest in the log.
The comparison is a join and the new marks are a plain maximum, so a busy author is never
gathered in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terravane.fixed_values import TOPIC_KEYWORDS
from terravane.functions.dates import iso_instant
from terravane.functions.strings import contains_any
from terravane.staging import drop_versions, finished_versions

MARKS_SCHEMA = "author string, mark timestamp"


def newer_than_marks(posts: DataFrame, marks: DataFrame, author: str, time: str,
                     since: datetime | None = None) -> DataFrame:
    """Posts after their author's mark; authors without one are compared with ``since``."""
    known = marks.select(F.col("author").alias("_author"), F.col("mark").alias("_mark"))
    floor = F.lit(since).cast("timestamp") if since else F.lit(None).cast("timestamp")
    mark = F.coalesce(F.col("_mark"), floor)
    joined = posts.join(known, F.col(author) == F.col("_author"), "left")
    return joined.filter(mark.isNull() | (F.col(time) > mark)).drop("_author", "_mark")


def newest_posts(posts: DataFrame, author: str, time: str) -> DataFrame:
    """author, mark -- the newest post of each author; authors or times that are missing have none."""
    return (posts.select(F.col(author).alias("author"), F.col(time).alias("mark"))
            .groupBy("author").agg(F.max("mark").alias("mark")).filter(F.col("mark").isNotNull()))


def advanced_marks(posts: DataFrame, marks: DataFrame, author: str, time: str) -> DataFrame:
    """Marks moved up to the newest post of each author; never moved back."""
    newest = newest_posts(posts, author, time)
    return (marks.select("author", "mark").unionByName(newest)
            .groupBy("author").agg(F.max("mark").alias("mark"))
            .filter(F.col("mark").isNotNull()))


def moved_marks(posts: DataFrame, marks: DataFrame, author: str, time: str) -> DataFrame:
    """Only the marks that the posts move, with their new value."""
    newest = newest_posts(posts, author, time)
    known = marks.select(F.col("author").alias("_author"), F.col("mark").alias("_mark"))
    joined = newest.join(known, F.col("author").eqNullSafe(F.col("_author")), "left")
    return joined.filter(F.col("_mark").isNull() | (F.col("mark") > F.col("_mark"))).select("author", "mark")


class MarkedFeed:
    """A feed of (author, created_at, text) filtered by marks and topic words.

    ``since`` is the mark of authors that have none yet. A live feed passes its start
    time, so that older posts are left out; None lets every post of a new author pass.
    """

    def __init__(self, spark: SparkSession, path: str, since: datetime | None = None,
                 keywords: Sequence[str] = tuple(TOPIC_KEYWORDS), fold_every: int = 100):
        self.spark = spark
        self.path = path.rstrip("/")
        self.since = since
        self.keywords = list(keywords)
        self.fold_every = fold_every

    def marks_before(self, batch_id: int | None = None) -> DataFrame:
        """Marks as the micro-batches before one left them (all of them if None)."""
        def before(folder: str, label: str) -> list[int]:
            found = finished_versions(self.spark, f"{self.path}/{folder}", label)
            return [v for v in found if batch_id is None or v < batch_id]

        read = self.spark.read.schema(MARKS_SCHEMA)
        folds = before("folded", "upto")[-1:]
        parts = [f"{self.path}/folded/upto={v}" for v in folds]
        parts += [f"{self.path}/moved/batch_id={v}" for v in before("moved", "batch_id") if v > max(folds, default=-1)]
        if not parts:
            return self.spark.createDataFrame([], MARKS_SCHEMA)
        return read.parquet(*parts).groupBy("author").agg(F.max("mark").alias("mark"))

    def write_moved(self, moved: DataFrame, batch_id: int) -> None:
        """Add the marks that a micro-batch moved; a replayed batch replaces its own.

        Every ``fold_every`` batches the marks are also written in one piece. The log up to the
        fold before goes, so a replay of this batch still finds what was before it.
        """
        moved.write.mode("overwrite").parquet(f"{self.path}/moved/batch_id={batch_id}")
        folds = finished_versions(self.spark, f"{self.path}/folded", "upto")
        last = max((v for v in folds if v < batch_id), default=-1)
        if batch_id - last >= self.fold_every:
            own = self.spark.read.schema(MARKS_SCHEMA).parquet(f"{self.path}/moved/batch_id={batch_id}")
            folded = self.marks_before(batch_id).unionByName(own).groupBy("author").agg(F.max("mark").alias("mark"))
            folded.write.mode("overwrite").parquet(f"{self.path}/folded/upto={batch_id}")
            drop_versions(self.spark, f"{self.path}/moved", "batch_id", last)
            drop_versions(self.spark, f"{self.path}/folded", "upto", last - 1)

    def poll(self, posts: DataFrame, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(posts to send, marks moved) of one micro-batch."""
        timed = posts.withColumn("_at", iso_instant("created_at"))
        fresh = newer_than_marks(timed, marks, "author", "_at", self.since)
        to_send = fresh.filter(contains_any("text", self.keywords)).select(
            "author", "created_at", "text")
        return to_send, moved_marks(timed, marks, "author", "_at")

    def start(self, posts: DataFrame, send: Callable[[DataFrame, int], None],
              checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Run the feed. ``send(frame, batch_id)`` must write a batch idempotently.

        Marks are written after the posts are sent. A replayed batch reads the marks of
        the batch before it, so it sends the same posts again and never loses one.
        """
        def on_batch(batch: DataFrame, batch_id: int) -> None:
            batch.persist()
            try:
                to_send, moved = self.poll(batch, self.marks_before(batch_id))
                send(to_send, batch_id)
                self.write_moved(moved, batch_id)
            finally:
                batch.unpersist()

        writer = posts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(on_batch)
        return writer.queryName("marked_feed").trigger(
            **(trigger or {"processingTime": "1 second"})).start()


def send_to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """Sender that writes each batch as JSON lines into its own folder."""
    def send(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").json(f"{path.rstrip('/')}/batch_id={batch_id}")
    return send


def send_to_kafka(options: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """Sender for a Kafka topic; see ``messages.kafka_sink_options``."""
    from terravane.sources.messages import as_kafka_values

    def send(df: DataFrame, batch_id: int) -> None:
        as_kafka_values(df).write.format("kafka").options(**options).save()
    return send
