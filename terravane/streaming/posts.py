"""Streaming queries over posts: landing, enrichment, forum messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from terravane.functions.dates import iso_instant
from terravane.operators.text import enrich_posts
from terravane.sources import messages
from terravane.streaming.counters import CounterLog


def decoded_posts(lines: DataFrame) -> DataFrame:
    return messages.decode(lines, messages.POST_SCHEMA)


def drop_repeats(posts: DataFrame, delay: str = "1 hour", time: str = "event_time") -> DataFrame:
    """Optional: drop a post that arrives again within ``delay`` of event time.

    Without a column of that name the time is ``created_at``, or the arrival if that is no time.
    """
    if time not in posts.columns:
        posts = posts.withColumn(time, F.coalesce(iso_instant("created_at"), F.current_timestamp()))
    return (posts.withWatermark(time, delay)
            .dropDuplicatesWithinWatermark(["author", "created_at", "text"]))


def land_posts(lines: DataFrame, path: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    return messages.land_messages(decoded_posts(lines), path, checkpoint, "land_posts", trigger)


def land_rejects(lines: DataFrame, path: str, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Messages that are no JSON object, one per line."""
    bad = messages.rejected(decoded_posts(lines))
    bad = bad.select(messages.as_line("value").alias("value"))
    return messages.start(bad, "text", path, checkpoint, "land_rejects", trigger)


def enrich(lines: DataFrame, path: str, checkpoint: str,
           tagger: Callable[[Column], Column] | None = None,
           classifier: Callable[[Column], Column] | None = None,
           trigger: dict | None = None) -> StreamingQuery:
    """Append one JSON line per post and city."""
    posts = messages.well_formed(decoded_posts(lines))
    return messages.start(enrich_posts(posts, tagger, classifier), "json", path, checkpoint,
                          "enrich_posts", trigger)


def count_labels(spark: SparkSession, enriched_path: str, log: CounterLog, checkpoint: str,
                 trigger: dict | None = None) -> StreamingQuery:
    """Running counters per city over the enriched files, so no text is labelled twice.

    Every enriched line has a city; one without is broken and not counted.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(enriched_path)  # may not have a batch yet
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    stream = spark.readStream.schema(messages.ENRICHED_SCHEMA).json(enriched_path)
    return log.start(stream.filter(F.col(log.key).isNotNull()), checkpoint, trigger)


def land_forum(lines: DataFrame, path: str, checkpoint: str,
               trigger: dict | None = None) -> StreamingQuery:
    """Land forum posts and heartbeats together, exactly as they came."""
    decoded = messages.decode(lines, messages.FORUM_SCHEMA)
    return messages.land_messages(decoded, path, checkpoint, "land_forum", trigger)
