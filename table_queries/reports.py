"""Aggregates, profiles, rankings and dashboard reads."""

from pyspark.sql import functions as F

from table_queries.registry import Registry, table
from terravane.operators import aggregates, columns, medians, ranking
from terravane.plans import reports
from terravane.staging import fresh_path

registry = Registry()

EVENT_COUNTERS = {"purchase": "positive", "error": "negative"}


@registry.query("""
SELECT event_id, round(coalesce(v, (SELECT median(CASE WHEN event_type <> 'view' THEN value END)
                                    FROM events)), 6) AS v
FROM (SELECT event_id, CASE WHEN event_type <> 'view' THEN value END AS v FROM events)
""")
def median_impute(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("value")).alias("v"))
    return medians.impute_medians(df, "v").withColumn("v", F.round("v", 6))


@registry.query("""
SELECT round(median(l_quantity), 6) AS l_quantity,
       round(median(l_extendedprice), 6) AS l_extendedprice,
       round(median(l_discount), 6) AS l_discount
FROM lineitem
""")
def median_spread(spark, sf_dir):
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    found = medians.spread_medians(table(spark, sf_dir, "lineitem").select(*names), *names)
    return found.select(*[F.round(n, 6).alias(n) for n in names])


@registry.query("""
SELECT user_id, count(*) FILTER (event_type = 'purchase') AS positive,
       count(*) FILTER (event_type = 'error') AS negative,
       count(*) FILTER (event_type NOT IN ('purchase', 'error')) AS neutral
FROM events GROUP BY user_id
""")
def sentiment_counts(spark, sf_dir):
    return aggregates.label_counts(
        table(spark, sf_dir, "events"), "user_id", "event_type", EVENT_COUNTERS)


_RANKED = """
SELECT user_id, score, row_number() OVER (ORDER BY score DESC, user_id) AS position
FROM (SELECT user_id, count(*) FILTER (event_type = 'purchase')
                      - count(*) FILTER (event_type = 'error') AS score
      FROM events GROUP BY user_id)
"""


def _scores(spark, sf_dir):
    return sentiment_counts(spark, sf_dir).select("user_id", ranking.net_score().alias("score"))


@registry.query(f"SELECT user_id, score, CAST(position AS BIGINT) AS position FROM ({_RANKED})")
def sentiment_ranking(spark, sf_dir):
    return ranking.number_rows(_scores(spark, sf_dir), [F.desc("score"), F.col("user_id")])


@registry.query("""
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT)
       AS position FROM orders
""")
def number_all_orders(spark, sf_dir):
    """Row numbers over a whole table by the distributed sort."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return ranking.number_rows(
        df, [F.desc("o_totalprice"), F.col("o_orderkey")]).select("o_orderkey", "position")


@registry.query("""
SELECT CAST(position AS BIGINT) AS position,
       CASE position WHEN 1 THEN '🥇' WHEN 2 THEN '🥈' WHEN 3 THEN '🥉' ELSE '' END AS medal,
       city, score
FROM (SELECT n_name AS city, score, row_number() OVER (ORDER BY score DESC, n_name) AS position
      FROM (SELECT n_name, count(*) FILTER (o_orderstatus = 'F')
                           - count(*) FILTER (o_orderstatus = 'O') AS score
            FROM orders JOIN customer ON o_custkey = c_custkey
            JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name))
""")
def city_ranking(spark, sf_dir):
    posts = (table(spark, sf_dir, "orders")
             .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
             .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")))
    counters = aggregates.label_counts(
        posts, "n_name", "o_orderstatus", {"F": "positive", "O": "negative"})
    return reports.city_ranking(counters, "n_name")


@registry.query("""
SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 10
""")
def latest_rows(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    return ranking.latest(df, "ts", 10, F.desc("event_id"))


@registry.query("""
SELECT ts AS created_at, event_type AS city, props AS text,
       CAST(user_id AS VARCHAR) AS assessment, value AS score
FROM events ORDER BY ts DESC, event_type, props LIMIT 10
""")
def latest_posts(spark, sf_dir):
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    enriched = table(spark, sf_dir, "events").select(
        stamp.alias("created_at"), F.col("event_type").alias("city"), F.col("props").alias("text"),
        F.col("user_id").cast("string").alias("assessment"), F.col("value").alias("score"))
    newest = reports.latest_posts(enriched)
    return newest.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@registry.query("SELECT event_id, props FROM events ORDER BY event_id DESC LIMIT 5")
def tail_rows(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "props")
    return ranking.tail(df, 5, ["event_id"])


@registry.query("SELECT * FROM part ORDER BY p_partkey LIMIT 10")
def preview_rows(spark, sf_dir):
    _, first = reports.table_explorer(table(spark, sf_dir, "part"), 10, ["p_partkey"])
    return first


@registry.query("""
SELECT 'part' AS tbl, count(*) AS "rows", 6 AS "columns" FROM part
UNION ALL SELECT 'events', count(*), 6 FROM events
""")
def table_shapes(spark, sf_dir):
    shapes = [aggregates.table_shape(table(spark, sf_dir, n)).withColumn("tbl", F.lit(n))
              for n in ("part", "events")]
    return shapes[0].unionByName(shapes[1])


@registry.query("""
SELECT bin, n, mn + (mx - mn) / 30 * bin AS low, mn + (mx - mn) / 30 * (bin + 1) AS high FROM (
  SELECT CAST(least(29, floor((o_totalprice - mn) / (mx - mn) * 30)) AS INTEGER) AS bin,
         count(*) AS n, mn, mx
  FROM orders, (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders)
  GROUP BY 1, mn, mx)
""")
def histogram_bins(spark, sf_dir):
    return reports.numeric_explorer(
        table(spark, sf_dir, "orders"), "histogram", "o_totalprice", bins=30)


@registry.query("SELECT p_partkey AS x, p_size AS y FROM part")
def scatter_pair(spark, sf_dir):
    return reports.numeric_explorer(table(spark, sf_dir, "part"))


@registry.query("SELECT event_id AS x, value AS y FROM events")
def scatter_chosen(spark, sf_dir):
    return columns.coordinate_pair(table(spark, sf_dir, "events"), "event_id", "value")


@registry.query("""
SELECT 'v' AS "column", count(*) AS "rows", count(*) FILTER (v IS NULL) AS nulls,
       count(*) FILTER (v IS NULL) > 0 AS any_null, count(v) = 0 AS all_null
FROM (SELECT CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS v FROM customer)
UNION ALL SELECT 'c_custkey', count(*), 0, false, false FROM customer
UNION ALL SELECT 'absent', count(*), count(*), true, true FROM customer
""")
def null_profile(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") != 3, F.col("c_nationkey")).alias("v"), "c_custkey")
    return aggregates.null_profile(columns.add_missing(df, absent="string"))


@registry.query("""
SELECT round(count(DISTINCT text) / count(*), 6) AS text,
       round(count(DISTINCT source) / count(*), 6) AS source,
       round(count(DISTINCT lang) / count(*), 6) AS lang
FROM documents
""")
def distinct_ratios(spark, sf_dir):
    ratios = aggregates.distinct_ratios(table(spark, sf_dir, "documents"))
    return ratios.select(*[F.round(c, 6).alias(c) for c in ratios.columns])


@registry.query("""
SELECT unnest(['text', 'lang', 'props']) AS "column", unnest([
  (SELECT count(*) FROM documents), (SELECT count(*) FROM documents), (SELECT count(*) FROM events)]) AS "rows",
  true AS close
""")
def distinct_ratios_merged(spark, sf_dir):
    """Sketches per source or event type, stored, read and merged: within 3 % of the exact ratios."""
    found, exact = [], []
    for name, by, columns_ in (("documents", "source", ["text", "lang"]), ("events", "event_type", ["props"])):
        df = table(spark, sf_dir, name)
        path = fresh_path(spark, "sketches")
        aggregates.distinct_sketches(df, [by], *columns_).write.parquet(path)
        found.append(aggregates.sketched_ratios(spark.read.parquet(path)))
        exact.append(aggregates.distinct_ratios(df, *columns_).select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("exact")) for c in columns_]))))
    both = found[0].unionByName(found[1]).join(exact[0].unionByName(exact[1]), "column")
    return both.select("column", "rows", (F.abs(F.col("ratio") / F.col("exact") - 1) <= 0.03).alias("close"))


@registry.query("""
SELECT 'lineitem' AS dataset, 'qty_range' AS rule,
       count(*) FILTER (l_quantity NOT BETWEEN 5 AND 40) AS violations, count(*) AS "rows"
FROM lineitem
UNION ALL SELECT 'lineitem', 'price_vs_qty',
       count(*) FILTER (l_extendedprice < l_quantity * 1000), count(*) FROM lineitem
UNION ALL SELECT 'lineitem', 'tax_over_discount',
       count(*) FILTER (l_tax > l_discount), count(*) FROM lineitem
""")
def rule_report(spark, sf_dir):
    return aggregates.rule_report(table(spark, sf_dir, "lineitem"), {
        "qty_range": ~F.col("l_quantity").between(5, 40),
        "price_vs_qty": F.col("l_extendedprice") < F.col("l_quantity") * 1000,
        "tax_over_discount": F.col("l_tax") > F.col("l_discount"),
    }, "lineitem")


@registry.query("""
SELECT bool_and(l_quantity % 1 = 0) AS l_quantity, bool_and(l_tax % 1 = 0) AS l_tax
FROM lineitem
""")
def integrality(spark, sf_dir):
    return aggregates.integrality(table(spark, sf_dir, "lineitem"), "l_quantity", "l_tax")
