"""Landing and zone round trips. Everything is written below the checkpoint folder."""

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from table_queries.registry import Registry, table
from terravane.operators import dedup, ranking
from terravane.sources import landing, messages, zones
from terravane.staging import fresh_path

registry = Registry()


@registry.query("""
SELECT CAST(s_suppkey AS VARCHAR) AS Supp_Key, s_name AS Name,
       CAST(s_nationkey AS VARCHAR) AS Nation__no__
FROM supplier
""")
def csv_landing(spark, sf_dir):
    """Write CSV, land it as text, find it again in the zone."""
    root = fresh_path(spark, "landing")
    raw = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    raw.toDF("Supp Key", "Name", "Nation (no.)").write.option("header", True).csv(f"{root}-csv")
    landing.land_csv(spark, f"{root}-csv", root, "suppliers")
    found, _ = landing.read_zone(spark, root)
    return found["suppliers"].drop(dedup.ORDINAL)


@registry.query("""
SELECT CAST(s_suppkey AS VARCHAR) AS "key", s_name AS name, CASE WHEN s_nationkey >= 10
       THEN CAST(s_nationkey AS VARCHAR) END AS nation FROM supplier
""")
def csv_parts_by_name(spark, sf_dir):
    """Two CSV parts with their columns in another order, one without a column, as one table."""
    root = fresh_path(spark, "parts")
    raw = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    raw.filter("nation < 10").select("name", "key").write.option("header", True).csv(f"{root}-one")
    raw.filter("nation >= 10").select("nation", "key", "name").write.option("header", True).csv(f"{root}-two")
    landing.land_csv(spark, [f"{root}-one", f"{root}-two"], root, "suppliers")
    return landing.read_zone_table(spark, root, "suppliers").drop(dedup.ORDINAL)


@registry.query("""
SELECT c_custkey, c_acctbal FROM customer ORDER BY c_custkey LIMIT 10
""")
def csv_first_rows(spark, sf_dir):
    """The landed ordinal keeps the line order of the file."""
    root = fresh_path(spark, "ordered")
    schema = T.StructType([T.StructField("c_custkey", T.LongType()),
                           T.StructField("c_acctbal", T.DoubleType())])
    (table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy("c_custkey")
     .write.option("header", True).csv(f"{root}-csv"))
    landing.land_csv(spark, f"{root}-csv", root, "customers", schema=schema)
    return ranking.head(landing.read_zone_table(spark, root, "customers"), 10)


@registry.query("SELECT event_id, user_id, value, event_type FROM events")
def compacted_table(spark, sf_dir):
    """Many small files per event type become few, each of one event type as before."""
    root = fresh_path(spark, "compact")
    df = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type")
    source = f"{root}/events"
    df.repartition(16, "user_id").write.partitionBy("event_type").parquet(source)
    files = landing.compact(spark, source, f"{root}/events_compact")
    merged = landing.read_zone_table(spark, root, "events_compact")
    if len(merged.inputFiles()) > files or not all("/event_type=" in f for f in merged.inputFiles()):
        raise AssertionError("files or partitions are not those asked for")
    return merged


@registry.query("""
SELECT 'part' AS "table", count(*) AS "rows", 6 AS "columns" FROM part
UNION ALL SELECT 'supplier', count(*), 4 FROM supplier
""")
def zone_catalog(spark, sf_dir):
    """Save into a catalog zone, re-create only if absent, list and count."""
    zone = f"zone_{uuid.uuid4().hex[:12]}"
    zones.create_zone(spark, zone, fresh_path(spark, zone))
    zones.save_tables({n: table(spark, sf_dir, n) for n in ("part", "supplier")}, zone)
    zones.save_table(table(spark, sf_dir, "nation"), zone, "part", mode="ignore")
    return zones.zone_shapes(spark, zone)


@registry.query("""
SELECT 'before' AS step, 'part' AS "table", count(*) AS "rows", 6 AS "columns" FROM part
UNION ALL SELECT 'before', 'supplier', count(*), 4 FROM supplier
UNION ALL SELECT 'after', 'supplier', count(*), 4 FROM supplier
""")
def zone_reset(spark, sf_dir):
    """A zone that is emptied and filled again holds only what came after."""
    zone = f"zone_{uuid.uuid4().hex[:12]}"
    zones.create_zone(spark, zone, fresh_path(spark, zone))
    zones.save_tables({n: table(spark, sf_dir, n) for n in ("part", "supplier")}, zone)
    shapes = zones.zone_shapes(spark, zone).withColumn("step", F.lit("before"))
    before = landing.write_table(shapes, fresh_path(spark, "shapes"), "before")
    if zones.reset_zone(spark, zone) != ["part", "supplier"]:
        raise AssertionError("tables were left out of the reset")
    zones.save_table(table(spark, sf_dir, "supplier"), zone, "supplier")
    after = zones.zone_shapes(spark, zone).withColumn("step", F.lit("after"))
    return spark.read.parquet(before).unionByName(after)


@registry.query("""
SELECT c_custkey AS id, c_acctbal AS amount FROM customer
UNION ALL SELECT user_id, max(value) FROM events
WHERE user_id NOT IN (SELECT c_custkey FROM customer) GROUP BY 1
""")
def zone_upsert(spark, sf_dir):
    zone = f"zone_{uuid.uuid4().hex[:12]}"
    zones.create_zone(spark, zone, fresh_path(spark, zone))
    seen = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("id")).agg(
        F.max("value").alias("amount"))
    zones.save_table(seen, zone, "amounts")
    balances = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"))
    zones.upsert_table(balances, zone, "amounts", ["id"])
    return zones.read_tables(spark, zone)["amounts"]


def _files_of(spark, zone, condition):
    rows = zones.read_tables(spark, zone)["parts"].filter(condition)
    return {r[0] for r in rows.select("_metadata.file_path").distinct().collect()}


@registry.query("""
SELECT s_suppkey AS id, coalesce(l.n, s_nationkey) AS n, s_nationkey % 3 AS part
FROM supplier LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) AS l
ON s_suppkey = l_suppkey AND s_nationkey % 3 > 0
""")
def zone_upsert_partitioned(spark, sf_dir):
    """Merge into a partitioned table: it stays partitioned, and a partition without a change keeps its files."""
    zone = f"zone_{uuid.uuid4().hex[:12]}"
    zones.create_zone(spark, zone, fresh_path(spark, zone))
    supplier = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").cast("bigint").alias("n"),
        (F.col("s_nationkey") % 3).alias("part"))
    zones.save_table(supplier, zone, "parts", partition_by=["part"])
    sold = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("id")).agg(
        F.count(F.lit(1)).alias("n"))
    changes = supplier.drop("n").join(sold, "id").filter("part > 0")  # a partition stays out of the merge
    before = _files_of(spark, zone, "part = 0")
    zones.upsert_table(changes, zone, "parts", ["id"])
    if _files_of(spark, zone, "part = 0") != before:
        raise AssertionError("files of an untouched partition were written anew")
    parts = [c.name for c in spark.catalog.listColumns(f"{zone}.parts") if c.isPartition]
    if parts != ["part"]:
        raise AssertionError(f"partitioning lost: {parts}")
    return zones.read_tables(spark, zone)["parts"]


@registry.query("""
SELECT text FROM (
  SELECT doc_id, text FROM documents
  ORDER BY doc_id % 30 <> 0 DESC, doc_id % 3 DESC, doc_id DESC LIMIT 5)
""")
def stream_file_tail(spark, sf_dir):
    """Last lines of a stream folder: all documents in two appends, the first much smaller."""
    path = fresh_path(spark, "tail")
    docs = table(spark, sf_dir, "documents")
    early = F.coalesce(F.col("doc_id") % 30 == 0, F.lit(False))  # a thirtieth; the rest is later
    for part in (docs.filter(early), docs.filter(~early)):
        (part.orderBy(F.col("doc_id") % 3, "doc_id").select("text")
         .write.mode("append").json(path))
    lines = messages.read_json_lines(spark, path, messages.POST_SCHEMA, ordinal=True)
    return ranking.tail(lines, 5).select("text")


@registry.query("SELECT doc_id AS author, text FROM documents")
def json_lines(spark, sf_dir):
    """JSON Lines out and in; texts keep every character."""
    path = fresh_path(spark, "lines")
    table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("author"), "text").write.json(path)
    back = messages.read_json_lines(spark, path, messages.POST_SCHEMA)
    return back.select(F.col("author").cast("bigint").alias("author"), "text")
