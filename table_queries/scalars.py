"""Scalar functions, casts and row rules."""

from pyspark.sql import functions as F

from table_queries.registry import Registry, table
from terravane.functions import dates, names, numbers, strings
from terravane.operators import columns, filters

registry = Registry()


@registry.query("""
SELECT event_id, v FROM (
  SELECT event_id, try_cast(nullif(CASE event_type
      WHEN 'error' THEN '-' WHEN 'signup' THEN 'N/A' WHEN 'view' THEN '-' || CAST(value AS VARCHAR)
      ELSE CAST(value AS VARCHAR) END, '-') AS DOUBLE) AS v
  FROM events)
WHERE v IS NOT NULL AND v >= 0
""")
def sentinel_numeric(spark, sf_dir):
    text = F.col("value").cast("string")
    raw = (F.when(F.col("event_type") == "error", "-").when(F.col("event_type") == "signup", "N/A")
           .when(F.col("event_type") == "view", F.concat(F.lit("-"), text)).otherwise(text))
    df = table(spark, sf_dir, "events").select("event_id", raw.alias("v"))
    df = df.withColumn("v", numbers.num(numbers.missing_if("v", ["-"])))
    return filters.keep_non_negative(df, "v")


@registry.query("""
SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS bal FROM customer
""")
def null_below(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", numbers.null_below("c_acctbal", 0).alias("bal"))


@registry.query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_quantity BETWEEN 5 AND 40 THEN l_quantity END AS qty
FROM lineitem
""")
def null_outside(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        numbers.null_outside("l_quantity", (5, 40)).alias("qty"))


@registry.query("""
SELECT p_partkey, p_retailprice FROM part
WHERE p_size BETWEEN 5 AND 40 AND p_retailprice BETWEEN 900 AND 950
""")
def range_filter(spark, sf_dir):
    df = filters.keep_complete(table(spark, sf_dir, "part"), "p_size", "p_retailprice")
    df = filters.keep_between(df, p_size=(5, 40), p_retailprice=(900, 950))
    return df.select("p_partkey", "p_retailprice")


@registry.query("""
SELECT o_orderkey, st FROM (
  SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                          ELSE ' ' || o_orderstatus || ' ' END AS st FROM orders)
WHERE lower(trim(st)) IS DISTINCT FROM 'p'
""")
def exclude_null_safe(spark, sf_dir):
    st = F.when(F.col("o_orderpriority") != "5-LOW",
                F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(" ")))
    df = table(spark, sf_dir, "orders").select("o_orderkey", st.alias("st"))
    return filters.exclude_entity(df, "st", "p", strings.strip_lower)


@registry.query("""
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
""")
def year_range(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    return df.filter(dates.year_between(at, 1996, 1998)).select("o_orderkey", "o_totalprice")


@registry.query("""
SELECT c_custkey,
       CASE WHEN c_acctbal < 0 THEN -1 ELSE 1 END * abs(c_acctbal) AS lat,
       CASE WHEN c_acctbal < 0 THEN 1 ELSE -1 END * abs(c_acctbal) AS lon
FROM customer
""")
def hemisphere(spark, sf_dir):
    size, south = F.abs("c_acctbal").cast("string"), F.col("c_acctbal") < 0
    lat = F.concat(size, F.when(south, "s").otherwise("N"))
    lon = F.concat(size, F.when(south, "E").otherwise("w"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", numbers.latitude(lat).alias("lat"), numbers.longitude(lon).alias("lon"))


_PARTS_SQL = """
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, year(l_shipdate) AS y,
         CASE WHEN l_returnflag <> 'N' THEN 2 * l_linenumber END AS m,
         CASE WHEN l_linestatus <> 'O' THEN CAST(l_quantity AS BIGINT) END AS d
  FROM lineitem
"""


def _date_parts(spark, sf_dir, mode):
    year = F.year("l_shipdate").cast("string")
    month = F.when(F.col("l_returnflag") != "N", 2 * F.col("l_linenumber")).cast("string")
    day = F.when(F.col("l_linestatus") != "O", F.col("l_quantity")).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        dates.date_from_parts(year, month, day, mode).cast("date").alias("dt"))


@registry.query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       try_cast(format('{{:04d}}-{{:02d}}-{{:02d}}', y, coalesce(m, 1), coalesce(d, 1)) AS DATE) AS dt
FROM ({_PARTS_SQL})
""")
def date_from_parts(spark, sf_dir):
    return _date_parts(spark, sf_dir, "start")


@registry.query(f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN d IS NULL
            THEN last_day(try_cast(format('{{:04d}}-{{:02d}}-01', y, coalesce(m, 12)) AS DATE))
            ELSE try_cast(format('{{:04d}}-{{:02d}}-{{:02d}}', y, coalesce(m, 12), d) AS DATE) END AS dt
FROM ({_PARTS_SQL})
""")
def date_from_parts_end(spark, sf_dir):
    return _date_parts(spark, sf_dir, "end")


@registry.query("""
SELECT o.o_orderkey, l.l_partkey, l.l_suppkey,
       CASE WHEN o.o_orderdate > l.l_shipdate THEN o.o_orderdate ELSE l.l_shipdate END AS end_date
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
""")
def start_end_repair(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "l_partkey", "l_suppkey",
        columns.repair_end(F.col("o_orderdate"), F.col("l_shipdate")).alias("end_date"))


@registry.query(r"""
SELECT p_partkey,
       array_to_string(list_transform(
           regexp_extract_all(lower(p_name || '-' || p_brand), '([\p{L}]+|[^\p{L}]+)'),
           lambda x: upper(x[1]) || lower(x[2:])), '') AS t
FROM part
""")
def title_case(spark, sf_dir):
    name = F.concat_ws("-", "p_name", "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", strings.title_case(name).alias("t"))


@registry.query("""
SELECT doc_id, CASE WHEN t IN ('nan', 'none', '', 'null') THEN NULL ELSE t END AS t
FROM (SELECT doc_id, lower(trim(CASE lang WHEN 'en' THEN ' NaN ' WHEN 'fr' THEN 'None'
                                WHEN 'de' THEN '  ' ELSE ' ' || source || ' ' END)) AS t
      FROM documents)
""")
def normalize_text(spark, sf_dir):
    lang = F.col("lang")
    raw = (F.when(lang == "en", " NaN ").when(lang == "fr", "None").when(lang == "de", "\t ")
           .otherwise(F.concat(F.lit("\n "), F.col("source"), F.lit(" "))))
    return table(spark, sf_dir, "documents").select(
        "doc_id", strings.normalize_text(raw).alias("t"))


@registry.query("""
SELECT p_partkey, trim(t, '''') AS name
FROM (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN '''' || p_name || '''' ELSE p_name END AS t
      FROM part)
""")
def strip_quotes(spark, sf_dir):
    quoted = F.when(F.col("p_type") == "ECONOMY",
                    F.concat(F.lit("'"), F.col("p_name"), F.lit("'"))).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", strings.strip_quotes(quoted).alias("name"))


@registry.query("""
SELECT p_partkey, CASE WHEN regexp_full_match(t, '[A-Z]{3}') THEN t END AS iso
FROM (SELECT p_partkey, CASE WHEN p_size > 25 THEN lower(substr(p_type, 1, 3))
                             ELSE substr(p_type, 1, 3) END AS t FROM part)
""")
def iso_shape(spark, sf_dir):
    start = F.substring("p_type", 1, 3)
    code = F.when(F.col("p_size") > 25, F.lower(start)).otherwise(start)
    return table(spark, sf_dir, "part").select(
        "p_partkey", strings.iso_code_or_null(code).alias("iso"))


@registry.query("""
SELECT o_orderkey, dt, CAST(year(dt) AS INTEGER) AS yr
FROM (SELECT o_orderkey, CAST(try_strptime(CASE o_orderstatus
          WHEN 'P' THEN 'bad' WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
          ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d') AS DATE) AS dt FROM orders)
""")
def lenient_date(spark, sf_dir):
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    raw = (F.when(status == "P", "bad").when(status == "F", F.date_format(day, "dd/MM/yyyy"))
           .otherwise(F.date_format(day, "yyyy-MM-dd")))
    parsed = dates.lenient_timestamp(raw).cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parsed.alias("dt"), F.year(parsed).alias("yr"))


@registry.query("""
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS dt
FROM orders
""")
def strict_date(spark, sf_dir):
    raw = F.date_format("o_orderdate", "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", dates.strict_timestamp(raw).cast("date").alias("dt"))


@registry.query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts - INTERVAL 2 HOUR END AS at
FROM events
""")
def iso_instant(spark, sf_dir):
    stamp = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'")
    raw = F.when(F.col("event_type") == "error", "12:30").otherwise(stamp)
    return table(spark, sf_dir, "events").select(
        "event_id", dates.iso_instant(raw).cast("timestamp_ntz").alias("at"))


@registry.query("SELECT c_custkey, CAST(c_acctbal AS FLOAT) AS bal FROM customer")
def downcast(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("bal"))
    return columns.to_float32(df)


@registry.query("""
SELECT c_custkey, CASE WHEN x = floor(x) THEN CAST(x AS BIGINT) END AS i
FROM (SELECT c_custkey, c_custkey / 4.0 AS x FROM customer)
""")
def integral_cast(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_custkey") / 4.0).cast("string").alias("i"))
    return columns.to_whole_numbers(df, "i")


@registry.query("""
SELECT c_custkey AS acct_id, c_acctbal AS acct_bal_usd_0, c_nationkey AS acct_bal_usd_1,
       c_name AS unnamed_col
FROM customer
""")
def snake_case_names(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_name")
    return names.snake_case_columns(df.toDF("Acct ID", "Acct Bal (USD)", "acct  bal usd", "%%"))


@registry.query("SELECT s_suppkey AS AQI_Value, s_acctbal AS Avg_Temp___C_ FROM supplier")
def landed_names(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return names.sanitize_columns(df.toDF("AQI Value", "Avg Temp (°C)"))


@registry.query("""
SELECT n_name AS country, n_nationkey AS id, CAST(NULL AS DOUBLE) AS score, n_regionkey AS iso
FROM nation
""")
def renamed_reordered(spark, sf_dir):
    df = names.strip_column_names(
        table(spark, sf_dir, "nation").toDF(" n_nationkey", "n_name ", "n_regionkey"))
    df = columns.rename_present(
        df, {"n_nationkey": "id", "n_name": "country", "n_regionkey": "iso", "absent": "gone"})
    df = columns.add_missing(df, score="double")
    return columns.move_last(columns.move_first(df, "country"), "iso")


@registry.query("""
SELECT conv_id, turn, substr(text, 1, 50) AS preview FROM conversations
""")
def text_preview(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", strings.preview("text").alias("preview"))
