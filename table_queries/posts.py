"""Topic words, place detection, labels and high-water marks."""

from datetime import datetime

from pyspark.sql import functions as F

from table_queries.registry import Registry, table
from terravane.functions.strings import word_text
from terravane.operators import aggregates, filters, learned, text
from terravane.streaming.marks import advanced_marks, newer_than_marks

registry = Registry()

PLACES = ["the", "und", "les", "que", "der"]
GOOD, BAD = ["the", "les"], ["of", "que"]


@registry.query("""
SELECT doc_id FROM documents WHERE lower(text) LIKE '%ention%' OR lower(text) LIKE '%und%'
""")
def keyword_any(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    return filters.mentions_any(df, "text", ["Ention", "UND"]).select("doc_id")


_MENTIONS = r"""
SELECT doc_id, w AS city FROM (
  SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}]+')) AS w FROM documents)
WHERE w IN ('the', 'und', 'les', 'que', 'der')
"""


@registry.query(f"SELECT city, count(*) AS posts FROM ({_MENTIONS}) GROUP BY city")
def listed_place_counts(spark, sf_dir):
    df = text.detect_places(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", PLACES)
    return df.groupBy("city").agg(F.count(F.lit(1)).alias("posts"))


_PAIRS = r"""list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])"""


@registry.query(rf"""
SELECT doc_id, city FROM (
  SELECT doc_id, unnest(list_distinct(list_concat(tok, {_PAIRS}))) AS city
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}]+') AS tok FROM documents))
JOIN (SELECT DISTINCT unnest({_PAIRS}) AS run
      FROM (SELECT regexp_extract_all(lower(text), '[\p{{L}}]+') AS tok FROM benchmark)) ON run = city
""")
def gazetteer_mentions(spark, sf_dir):
    """Which documents contain which two-word runs of the benchmark texts."""
    words = table(spark, sf_dir, "benchmark").select(
        F.split(F.trim(word_text("text")), " ").alias("w")).filter(F.size("w") > 1)
    runs = F.transform(F.sequence(F.lit(1), F.size("w") - 1),
                       lambda i: F.array_join(F.slice(F.col("w"), i, 2), " "))
    gazetteer = words.select(F.explode(runs).alias("place")).distinct()
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.place_mentions(df, "text", gazetteer, ["doc_id"])


def _runs_sql(n):
    return f"list_transform(range(1, len(tok) - {n - 2}), lambda i: array_to_string(tok[i:i + {n - 1}], ' '))"


@registry.query(rf"""
SELECT doc_id, city FROM (
  SELECT doc_id, unnest(list_distinct(list_concat({_runs_sql(1)}, {_runs_sql(4)}, {_runs_sql(7)}))) AS city
  FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}]+') AS tok FROM documents))
JOIN (SELECT DISTINCT unnest([tok[-1], CASE WHEN len(tok) > 3 THEN array_to_string(tok[1:4], ' ') END,
                              CASE WHEN len(tok) > 6 THEN array_to_string(tok[1:7], ' ') END]) AS run
      FROM (SELECT regexp_extract_all(lower(text), '[\p{{L}}]+') AS tok FROM benchmark)) ON run = city
""")
def gazetteer_long_names(spark, sf_dir):
    """Names of one, four and seven words: the last word and the first words of benchmark texts."""
    words = table(spark, sf_dir, "benchmark").select(F.split(F.trim(word_text("text")), " ").alias("w"))
    starts = [F.when(F.size("w") >= n, F.array_join(F.slice("w", 1, n), " ")) for n in (4, 7)]
    gazetteer = words.select(F.explode(F.array(F.element_at("w", -1), *starts)).alias("place"))
    df = table(spark, sf_dir, "documents").select("doc_id", "text")
    return text.place_mentions(df, "text", gazetteer, ["doc_id"])


_LABELS = r"""
SELECT doc_id, CASE WHEN p > n THEN 'good' WHEN p < n THEN 'bad' ELSE 'neutral' END AS label,
       CASE WHEN p + n > 0 THEN greatest(p, n) / (p + n) ELSE 1.0 END AS score
FROM (SELECT doc_id, len(list_filter(tok, lambda x: x IN ('the', 'les'))) AS p,
             len(list_filter(tok, lambda x: x IN ('of', 'que'))) AS n
      FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}]+') AS tok FROM documents))
"""


@registry.query(f"SELECT doc_id, label, round(score, 6) AS score FROM ({_LABELS})")
def word_labels(spark, sf_dir):
    label = text.word_label("text", GOOD, BAD)
    return (table(spark, sf_dir, "documents").select("doc_id", label.alias("l"))
            .select("doc_id", "l.label", F.round("l.score", 6).alias("score")))


@registry.query(f"""
SELECT city, count(*) FILTER (label = 'good') AS positive,
       count(*) FILTER (label = 'bad') AS negative, count(*) FILTER (label = 'neutral') AS neutral
FROM ({_MENTIONS}) JOIN ({_LABELS}) USING (doc_id) GROUP BY city
""")
def city_sentiment(spark, sf_dir):
    """Posts to counters: detect places, label the text, count per place."""
    posts = table(spark, sf_dir, "documents").withColumn("created_at", F.col("doc_id"))
    enriched = text.enrich_posts(
        posts, tagger=lambda c: text.listed_places(c, PLACES),
        classifier=lambda c: text.word_label(c, GOOD, BAD))
    return aggregates.label_counts(enriched, "city", "assessment")


#: Labelled documents whose hash begins with one of these digits are not learned from.
_HELD_OUT = "01234"

_LEARNED = rf"""
WITH tok AS (
  SELECT doc_id, list_distinct(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}]+')) AS w,
         contains('{_HELD_OUT}', left(md5(CAST(doc_id AS VARCHAR)), 1)) AS held_out FROM documents),
known AS (SELECT w, 1 - toxic AS good FROM tok JOIN labels USING (doc_id) WHERE NOT held_out AND toxic IS NOT NULL),
sizes AS (SELECT sum(good) AS goods, count(*) - sum(good) AS bads FROM known),
weights AS (
  SELECT word, CAST(round(ln(((g + 1) / (goods + 2)) / ((n - g + 1) / (bads + 2))) * 1000000) AS BIGINT) AS weight
  FROM (SELECT word, sum(good) AS g, count(*) AS n FROM (SELECT unnest(w) AS word, good FROM known)
        WHERE length(word) <= 64 GROUP BY word ORDER BY n DESC, word LIMIT 65536), sizes),
means AS (SELECT doc_id, sum(weight) / count(*) AS mean
          FROM (SELECT doc_id, unnest(w) AS word FROM tok) JOIN weights USING (word) GROUP BY doc_id)
SELECT doc_id, held_out, round(mean) AS mean, CASE WHEN mean > 0 THEN 'good' WHEN mean < 0 THEN 'bad' ELSE 'neutral' END AS label,
       round(CASE WHEN mean IS NULL THEN 1 ELSE 1 / (1 + exp(-abs(mean) / 1000000)) END, 6) AS score
FROM tok LEFT JOIN means USING (doc_id)
"""


def _learned(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    first = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1)
    docs = docs.select("doc_id", "text", F.coalesce(first.isin(list(_HELD_OUT)), F.lit(False)).alias("held_out"))
    known = docs.filter(~F.col("held_out")).join(labels.select("doc_id", (1 - F.col("toxic")).alias("good")), "doc_id")
    model = learned.WordModel(learned.word_weights(known, "text", "good"))
    return docs.select("doc_id", "held_out", F.round(model.mean_weight("text")).alias("mean"),
                       model.label("text").alias("l"))


@registry.query(f"SELECT doc_id, held_out, label, score FROM ({_LEARNED})")
def learned_labels(spark, sf_dir):
    """Labels learned from labelled documents (toxic ones are bad), for every document."""
    return _learned(spark, sf_dir).select(
        "doc_id", "held_out", "l.label", F.round("l.score", 6).alias("score"))


@registry.query(f"""
WITH held AS (
  SELECT round(mean / 1000) AS step, sum(1 - toxic) AS good, count(*) AS n, sum(toxic) AS bad
  FROM ({_LEARNED}) JOIN labels USING (doc_id) WHERE held_out AND toxic IS NOT NULL GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS texts, CAST(sum(good) AS BIGINT) AS goods,
       round(sum(good * (coalesce(below, 0) + bad / 2)) / (sum(good) * sum(bad)), 6) AS area
FROM (SELECT *, sum(bad) OVER (ORDER BY step NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS below
      FROM held)
""")
def learned_labels_area(spark, sf_dir):
    """How well the learned labels tell held-out documents apart: area under the curve."""
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("toxic")).alias("good"))
    held = _learned(spark, sf_dir).filter("held_out").select("doc_id", (F.col("mean") / 1000).alias("mean"))
    found = learned.separation(held.join(labels, "doc_id"), "mean", "good", steps=1)
    return found.withColumn("area", F.round("area", 6))


_MARKS = "SELECT user_id, max(ts) AS m FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1"


@registry.query(f"""
SELECT e.event_id, e.user_id, e.ts FROM events e LEFT JOIN ({_MARKS}) h USING (user_id)
WHERE (h.m IS NULL OR e.ts > h.m) AND e.event_type IN ('click', 'view')
""")
def high_water_mark(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    fresh = newer_than_marks(events, _marks(events), "user_id", "ts")
    return fresh.filter(F.col("event_type").isin("click", "view")).select(
        "event_id", "user_id", "ts")


def _marks(events):
    return (events.filter(F.col("ts") < datetime(2024, 1, 15)).groupBy(F.col("user_id").alias("author"))
            .agg(F.max("ts").alias("mark")))


@registry.query("SELECT user_id AS author, max(ts) AS mark FROM events GROUP BY 1")
def advance_marks(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return advanced_marks(events, _marks(events), "user_id", "ts")
