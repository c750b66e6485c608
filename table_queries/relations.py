"""De-duplication, lookups, joins, unions and upserts."""

from pyspark.sql import functions as F

from table_queries.registry import Registry, table
from terravane.functions.dates import year_between
from terravane.operators import aggregates, dedup, joins, tables

registry = Registry()

LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@registry.query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)
WHERE rn = 1
""")
def keep_first(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return dedup.keep_first(df, ["l_orderkey", "l_linenumber"], LINE_ORDER).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@registry.query("""
SELECT k, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY l_shipdate, l_partkey, l_suppkey,
      l_extendedprice) AS rn
  FROM (SELECT *, CASE WHEN l_returnflag <> 'N' THEN l_suppkey END AS k FROM lineitem))
WHERE rn = 1
""")
def keep_first_null_key(spark, sf_dir):
    """A third of the rows share the missing key, of which one row stays."""
    key = F.when(F.col("l_returnflag") != "N", F.col("l_suppkey"))
    df = table(spark, sf_dir, "lineitem").withColumn("k", key)
    return dedup.keep_first(df, ["k"], LINE_ORDER).select("k", "l_partkey")


@registry.query("SELECT DISTINCT text, lang FROM documents")
def full_distinct(spark, sf_dir):
    return dedup.distinct_rows(table(spark, sf_dir, "documents").select("text", "lang"))


@registry.query("""
SELECT count(*) AS rows_in, count(DISTINCT (l_orderkey, l_linenumber)) AS rows_out FROM lineitem
""")
def dedup_audit(spark, sf_dir):
    return dedup.dedup_audit(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def _some_nations(spark, sf_dir):
    """Nations outside one region, so that some keys have no partner."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    kept = region.filter(F.col("r_name") != "AFRICA")
    return nation.join(kept, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi")


_SOME_NATIONS = """(SELECT n_nationkey, n_name FROM nation
    JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'AFRICA')"""


@registry.query(f"""
SELECT c_custkey, n_name FROM customer LEFT JOIN {_SOME_NATIONS} n ON c_nationkey = n_nationkey
""")
def lookup_left(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dim = _some_nations(spark, sf_dir)
    return joins.lookup(df, dim, "c_nationkey", "n_nationkey", "n_name", "n_name").drop(
        "c_nationkey")


@registry.query(f"""
SELECT c_custkey FROM customer
WHERE NOT EXISTS (SELECT 1 FROM {_SOME_NATIONS} n WHERE n_nationkey = c_nationkey)
""")
def lookup_rejects(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return joins.lookup_rejects(
        df, _some_nations(spark, sf_dir), "c_nationkey", "n_nationkey").select("c_custkey")


@registry.query(f"""
SELECT DISTINCT c_nationkey FROM customer
LEFT JOIN {_SOME_NATIONS} n ON c_nationkey = n_nationkey
WHERE n_nationkey IS NULL ORDER BY 1 LIMIT 10
""")
def unmatched_values(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    df = joins.lookup(df, _some_nations(spark, sf_dir), "c_nationkey", "n_nationkey",
                      "n_name", "n_name")
    return aggregates.unmatched_values(df, "c_nationkey", "n_name", limit=10)


# Spellings of countries as they come in, one per nation of the driver tables.
COUNTRY_SPELLINGS = [
    " south korea ", "TURKEY", "kosovo", "Atlantis", "france", "UK", "usa", "Viet Nam",
    "Vietnam", "ivory coast", "Syria", "Czech Republic", "TAIWAN", "isle of man", "Laos",
    "bosnia and herzegovina", "Guinea-Bissau", "Congo (Kinshasa)", "congo (brazzaville)",
    "São Tomé", "Macao", "Hong Kong S.A.R. of China", "RUSSIA", "state of palestine", "Japan",
]


def spelled_country(nation_key):
    return F.element_at(F.array(*[F.lit(s) for s in COUNTRY_SPELLINGS]), nation_key + 1)


COUNTRY_SQL = """
(VALUES (0, ' south korea ', 'KOR'), (1, 'TURKEY', 'TUR'), (2, 'kosovo', NULL),
 (3, 'Atlantis', NULL), (4, 'france', 'FRA'), (5, 'UK', 'GBR'), (6, 'usa', 'USA'),
 (7, 'Viet Nam', 'VNM'), (8, 'Vietnam', 'VNM'), (9, 'ivory coast', 'CIV'), (10, 'Syria', NULL),
 (11, 'Czech Republic', 'CZE'), (12, 'TAIWAN', NULL), (13, 'isle of man', 'IMN'),
 (14, 'Laos', 'LAO'), (15, 'bosnia and herzegovina', 'BIH'), (16, 'Guinea-Bissau', 'GNB'),
 (17, 'Congo (Kinshasa)', 'COD'), (18, 'congo (brazzaville)', 'COG'), (19, 'São Tomé', NULL),
 (20, 'Macao', 'MAC'), (21, 'Hong Kong S.A.R. of China', 'HKG'), (22, 'RUSSIA', 'RUS'),
 (23, 'state of palestine', 'PSE'), (24, 'Japan', 'JPN')) AS spelling(k, name, iso)"""


@registry.query(f"""
SELECT c_custkey, name AS country, iso AS CountryISO
FROM customer JOIN {COUNTRY_SQL} ON c_nationkey = k
""")
def country_code(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", spelled_country(F.col("c_nationkey")).alias("country"))
    return joins.add_country_code(df, "country")


@registry.query("""
SELECT c_custkey, s_suppkey, c_acctbal AS acctbal_x, s_acctbal AS ACCTBAL_y
FROM (SELECT *, CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS k FROM customer) c
JOIN (SELECT *, CASE WHEN s_nationkey <> 3 THEN s_nationkey END AS k FROM supplier) s
  ON c.k IS NOT DISTINCT FROM s.k
""")
def join_null_safe(spark, sf_dir):
    left, right = _null_key_sides(spark, sf_dir)
    return joins.inner_join(left, right, ["k"], match_nulls=True, block=128, parts=16).drop("k")


def _null_key_sides(spark, sf_dir):
    def key(c):
        return F.when(F.col(c) != 3, F.col(c)).alias("k")

    left = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("acctbal"), key("c_nationkey"))
    right = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.col("s_acctbal").alias("ACCTBAL"), key("s_nationkey"))
    return left, right


@registry.query("""
SELECT c_custkey, s_suppkey FROM customer c JOIN supplier s ON c_nationkey = s_nationkey
WHERE c_nationkey <> 3
""")
def join_nulls_apart(spark, sf_dir):
    left, right = _null_key_sides(spark, sf_dir)
    return joins.inner_join(left, right, ["k"], block=128, parts=16).select("c_custkey", "s_suppkey")


@registry.query("""
SELECT e.event_id, c.c_custkey
FROM (SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 0 ELSE user_id END AS k
      FROM events) e
JOIN customer c ON c.c_custkey = e.k
""")
def join_hot_key(spark, sf_dir):
    """More than a third of the events share one key, which is salted."""
    key = F.when(F.col("event_type").isin("view", "click"), 0).otherwise(F.col("user_id"))
    left = table(spark, sf_dir, "events").select("event_id", key.alias("k"))
    right = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("k"))
    return joins.inner_join(left, right, ["k"], hot_share=0.05, salts=16).drop("k")


@registry.query("""
SELECT count(*) FILTER (v IS NULL) AS null_k
FROM (SELECT CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS v FROM customer)
""")
def null_join_keys(spark, sf_dir):
    left, _ = _null_key_sides(spark, sf_dir)
    return joins.null_key_count(left, ["k"])


@registry.query("""
SELECT o_orderkey, l_partkey, l_suppkey, c_nationkey AS nationkey, o_orderdate AS dt,
       CAST(year(o_orderdate) AS INTEGER) AS year_x, CAST(year(l_shipdate) AS INTEGER) AS year_y
FROM orders JOIN customer ON o_custkey = c_custkey
JOIN (lineitem JOIN supplier ON l_suppkey = s_suppkey)
  ON c_nationkey = s_nationkey AND o_orderdate = l_shipdate
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
""")
def mart_two_key(spark, sf_dir):
    """Orders and shipments of the same nation and day, both cut to the year range first."""
    def in_range(df):
        return df.filter(year_between("dt", 1996, 1999))

    orders = in_range(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp").alias("dt")))
    left = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lines = in_range(table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("dt")))
    right = lines.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    mart = joins.inner_join(
        left.select("o_orderkey", F.col("c_nationkey").alias("nationkey"), "dt",
                    F.year("dt").alias("year")),
        right.select("l_partkey", "l_suppkey", F.col("s_nationkey").alias("nationkey"), "dt",
                     F.year("dt").alias("year")),
        ["nationkey", "dt"], match_nulls=True, block=128)
    return mart.withColumn("dt", F.col("dt").cast("timestamp_ntz"))


@registry.query("""
SELECT c_custkey AS id, c_acctbal AS bal, c_mktsegment AS seg FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier
""")
def union_missing(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("bal"),
        F.col("c_mktsegment").alias("seg"))
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"))
    return tables.union_all(customers, suppliers)


@registry.query("""
WITH p AS (SELECT event_id AS id FROM events WHERE event_type = 'refund')
SELECT id FROM p UNION ALL SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM p)
""")
def backup_for_empty(spark, sf_dir):
    primary = table(spark, sf_dir, "events").filter("event_type = 'refund'").select(
        F.col("event_id").alias("id"))
    backup = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return tables.primary_or_backup(primary, backup)


@registry.query("SELECT event_id AS id FROM events WHERE event_type = 'purchase'")
def primary_over_backup(spark, sf_dir):
    primary = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select(
        F.col("event_id").alias("id"))
    backup = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return tables.primary_or_backup(primary, backup)


@registry.query("""
WITH spent AS (SELECT o_custkey AS id, max(o_totalprice) AS amount FROM orders GROUP BY 1),
     seen AS (SELECT user_id AS id, max(value) AS amount FROM events GROUP BY 1)
SELECT id, amount FROM spent
UNION ALL
SELECT id, amount FROM seen WHERE id NOT IN (SELECT id FROM spent)
""")
def upsert_rows(spark, sf_dir):
    spent = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.max("o_totalprice").alias("amount"))
    seen = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.max("value").alias("amount"))
    return tables.upsert(seen, spent, ["id"])
