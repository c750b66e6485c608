"""Structured Streaming over the driver tables, drained with ``availableNow``."""

from datetime import datetime

from pyspark.sql import functions as F

from table_queries.payloads import mixed_topic
from table_queries.posts import BAD, GOOD, PLACES, _LABELS, _MENTIONS
from table_queries.registry import Registry, table
from terravane.operators import text
from terravane.sources import messages
from terravane.staging import fresh_path
from terravane.streaming import control, posts
from terravane.streaming.counters import CounterLog
from terravane.streaming.marks import MarkedFeed, send_to_folder

registry = Registry()

ALL_NOW = {"availableNow": True}


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@registry.query("""
SELECT user_id, event_type AS counter, count(*) AS n FROM events GROUP BY 1, 2
""")
def stream_counts(spark, sf_dir):
    root = fresh_path(spark, "counts")
    log = CounterLog(f"{root}/log", key="user_id", label="event_type")
    query = log.start(_event_stream(spark, sf_dir), f"{root}/checkpoint", ALL_NOW,
                      counter=F.col("event_type"), name=None)
    control.drain([query])
    return log.current_long(spark)


def _document_lines(spark, sf_dir, root):
    """The documents as JSON messages in a folder a stream can read."""
    message = F.struct(F.col("source").alias("author"), F.col("doc_id").alias("created_at"), "text")
    table(spark, sf_dir, "documents").select(
        F.to_json(message).alias("value")).write.text(f"{root}/topic")
    return messages.message_stream(spark, f"{root}/topic")


@registry.query(f"""
SELECT city, count(*) FILTER (label = 'good') AS positive,
       count(*) FILTER (label = 'bad') AS negative, count(*) FILTER (label = 'neutral') AS neutral
FROM ({_MENTIONS}) JOIN ({_LABELS}) USING (doc_id) GROUP BY city
""")
def stream_sentiment(spark, sf_dir):
    """Messages to enriched posts to counters, each step its own streaming query."""
    root = fresh_path(spark, "sentiment")
    lines = _document_lines(spark, sf_dir, root)
    control.drain([posts.enrich(
        lines, f"{root}/enriched", f"{root}/enrich-checkpoint",
        tagger=lambda c: text.listed_places(c, PLACES),
        classifier=lambda c: text.word_label(c, GOOD, BAD), trigger=ALL_NOW)])
    log = CounterLog(f"{root}/counters")
    control.drain([posts.count_labels(
        spark, f"{root}/enriched", log, f"{root}/count-checkpoint", ALL_NOW)])
    return log.current(spark)


@registry.query("SELECT source AS author, CAST(doc_id AS VARCHAR) AS created_at, text FROM documents")
def stream_landing(spark, sf_dir):
    """Messages landed unchanged and read back."""
    root = fresh_path(spark, "landed")
    lines = _document_lines(spark, sf_dir, root)
    control.drain([posts.land_posts(lines, f"{root}/landed", f"{root}/checkpoint", ALL_NOW)])
    return messages.read_json_lines(spark, f"{root}/landed", messages.POST_SCHEMA)


@registry.query("""
SELECT CAST(user_id AS VARCHAR) AS author, event_id, event_type AS text FROM events
WHERE ts > TIMESTAMP '2024-01-10' AND event_type IN ('click', 'view')
""")
def stream_marked_feed(spark, sf_dir):
    """Posts newer than the start mark that mention a topic word, sent batch by batch."""
    root = fresh_path(spark, "feed")
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    feed_lines = _event_stream(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("author"), stamp.alias("created_at"),
        F.concat_ws("|", "event_type", "event_id").alias("text"))
    feed = MarkedFeed(spark, f"{root}/marks", datetime(2024, 1, 10), ["CLICK", "view"])
    control.drain([feed.start(
        feed_lines, send_to_folder(f"{root}/sent"), f"{root}/checkpoint", ALL_NOW)])
    sent = messages.read_json_lines(spark, f"{root}/sent", messages.POST_SCHEMA)
    parts = F.split("text", r"\|")
    return sent.select("author", parts[1].cast("bigint").alias("event_id"), parts[0].alias("text"))


@registry.query("""
SELECT CAST(e.user_id AS VARCHAR) AS author, e.event_id, e.event_type AS text
FROM events e LEFT JOIN (
    SELECT poll, user_id, max(max(ts)) OVER (PARTITION BY user_id ORDER BY poll
               RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
    FROM (SELECT *, event_id % 3 AS poll FROM events) GROUP BY poll, user_id) m
  ON m.poll = e.event_id % 3 AND m.user_id = e.user_id
WHERE e.ts > coalesce(m.mark, TIMESTAMP '2024-01-10') AND e.event_type IN ('click', 'view')
""")
def stream_marked_polls(spark, sf_dir):
    """Three polls of the feed; each is compared with the marks that the polls before it left."""
    root = fresh_path(spark, "polls")
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    lines = table(spark, sf_dir, "events").select(
        (F.col("event_id") % 3).alias("poll"), F.to_json(F.struct(
            F.col("user_id").cast("string").alias("author"), stamp.alias("created_at"),
            F.concat_ws("|", "event_type", "event_id").alias("text"))).alias("value"))
    feed = MarkedFeed(spark, f"{root}/marks", datetime(2024, 1, 10), ["click", "view"])
    for poll in range(3):
        lines.filter(F.col("poll") == poll).select("value").write.mode("append").text(f"{root}/topic")
        arrived = messages.well_formed(posts.decoded_posts(
            messages.message_stream(spark, f"{root}/topic")))
        control.drain([feed.start(
            arrived, send_to_folder(f"{root}/sent"), f"{root}/checkpoint", ALL_NOW)])
    sent = messages.read_json_lines(spark, f"{root}/sent", messages.POST_SCHEMA)
    parts = F.split("text", r"\|")
    return sent.select("author", parts[1].cast("bigint").alias("event_id"), parts[0].alias("text"))


@registry.query("""
SELECT 'count_labels' AS name, false AS running, count(*) AS "rows" FROM events
""")
def stream_status(spark, sf_dir):
    """Status of a query that has read everything there is, as one batch."""
    root = fresh_path(spark, "status")
    log = CounterLog(f"{root}/log", key="user_id", label="event_type")
    query = log.start(_event_stream(spark, sf_dir), f"{root}/checkpoint", ALL_NOW,
                      counter=F.col("event_type"))
    control.drain([query])
    found = control.status([query])
    return spark.createDataFrame([(s["name"], s["running"], s["rows"]) for s in found],
                                 "name string, running boolean, rows bigint")


@registry.query("""
SELECT CASE event_type WHEN 'error' THEN 'HEARTBEAT' ELSE 'POST' END AS message_type,
       count(*) AS n
FROM events WHERE event_type NOT IN ('signup', 'purchase') GROUP BY 1
""")
def stream_forum(spark, sf_dir):
    """Posts and heartbeats land together; broken messages do not."""
    root = fresh_path(spark, "forum")
    mixed_topic(spark, sf_dir).write.text(f"{root}/topic")
    lines = messages.message_stream(spark, f"{root}/topic")
    control.drain([posts.land_forum(lines, f"{root}/landed", f"{root}/checkpoint", ALL_NOW)])
    landed = messages.read_json_lines(spark, f"{root}/landed", messages.FORUM_SCHEMA)
    return landed.groupBy("message_type").agg(F.count(F.lit(1)).alias("n"))
