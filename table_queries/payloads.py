"""JSON payloads, maps, arrays and message decoding."""

from pyspark.sql import functions as F

from table_queries.registry import Registry, table
from terravane import dimensions
from terravane.plans import ingest
from terravane.sources import landing, messages, payloads
from terravane.staging import fresh_path

registry = Registry()


@registry.query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract(props, '$.iaqi.no2.v') AS DOUBLE) AS no2
FROM events
""")
def json_nested(spark, sf_dir):
    parsed = F.from_json("props", "k bigint, iaqi struct<no2: struct<v: double>>")
    return table(spark, sf_dir, "events").select(
        "event_id", parsed["k"].alias("k"), parsed["iaqi"]["no2"]["v"].alias("no2"))


@registry.query("""
SELECT c_name AS city, c_acctbal AS latitude, c_acctbal / 2 AS longitude FROM customer
""")
def json_city_map(spark, sf_dir):
    """Every customer as a one-entry JSON object keyed by name."""
    at = F.struct(F.col("c_acctbal").alias("latitude"), (F.col("c_acctbal") / 2).alias("longitude"))
    objects = table(spark, sf_dir, "customer").select(
        F.to_json(F.create_map("c_name", at)).alias("value"))
    return dimensions.cities_from_json(objects)


@registry.query("""
SELECT vec_id, CAST(DATE '2024-01-01' + CAST(i - 1 AS INTEGER) AS DATE) AS date,
       round(CAST(embedding[i] AS DOUBLE), 6) AS v
FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
""")
def zip_dates_values(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    start = F.lit("2024-01-01").cast("date")
    days = payloads.dated_values(
        df, start, F.date_add(start, F.size("embedding") - 1), F.col("embedding"), "v")
    return days.select("vec_id", "date", F.round(F.col("v").cast("double"), 6).alias("v"))


_WEATHER_SQL = """
SELECT city, CAST(lat AS DOUBLE) AS latitude, CAST(lon AS DOUBLE) AS longitude,
       CAST(DATE '2024-01-01' + CAST(i - 1 AS INTEGER) AS DATE) AS date,
       round(CAST(embedding[i] AS DOUBLE), 5) AS temperature_2m_mean
FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
JOIN (VALUES (0, 'Paris', 48.85, 2.35), (1, 'Lima', -12.04, -77.03), (2, 'Cairo', 30.04, 31.23))
     AS c(k, city, lat, lon) ON label = k
"""


def _weather_raw(spark, sf_dir):
    """Each vector as one landed weather payload. Rejected: labels without a known city, and
    one more payload per vector whose last day comes before its first, or is no day at all."""
    city = (F.when(F.col("label") == 0, "Paris").when(F.col("label") == 1, "Lima")
            .when(F.col("label") == 2, "Cairo").otherwise("Atlantis"))
    start = F.lit("2024-01-01").cast("date")
    daily = F.struct(
        start.alias("start"), F.date_add(start, F.size("embedding") - 1).alias("end"),
        F.col("embedding").cast("array<double>").alias("temperature_2m_mean"))
    broken = daily.withField("end", F.when(F.col("vec_id") % 2 == 0, F.lit("2023-12-31"))
                             .otherwise(F.lit("soon")))
    vectors = table(spark, sf_dir, "embeddings").select(
        city.alias("city"), daily.alias("daily"), broken.alias("broken"))
    return vectors.select(F.explode(F.array(
        F.to_json(F.struct("city", "daily")),
        F.to_json(F.struct("city", F.col("broken").alias("daily"))))).alias("value"))


@registry.query(_WEATHER_SQL)
def weather_payloads(spark, sf_dir):
    days, _ = payloads.daily_weather(_weather_raw(spark, sf_dir))
    return days.withColumn("temperature_2m_mean", F.round("temperature_2m_mean", 5))


@registry.query(_WEATHER_SQL)
def ingest_weather(spark, sf_dir):
    """Payloads to a landed table; broken ones are rejected and the backup is not needed."""
    root = fresh_path(spark, "ingest")
    backup = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("city"), F.lit("2024-01-01").alias("date"))
    ingest.land_weather(_weather_raw(spark, sf_dir), root, backup)
    days = landing.read_zone_table(spark, root, ingest.WEATHER_TABLE)
    return days.withColumn("temperature_2m_mean", F.round("temperature_2m_mean", 5))


@registry.query("""
SELECT CAST(event_id AS VARCHAR) AS city, DATE '2024-02-01' AS date,
       CASE WHEN event_type <> 'view' THEN CAST(user_id AS DOUBLE) END AS aqi,
       value AS pm25, CAST(NULL AS DOUBLE) AS pm10, value / 2 AS no2
FROM events
""")
def ingest_station_backup(spark, sf_dir):
    """No station answers, so the whole backup lands, with its numbers as text coerced."""
    root = fresh_path(spark, "ingest")
    events = table(spark, sf_dir, "events")
    failed = events.select(F.col("event_id").cast("string").alias("city"),
                           F.lit('{"status": "error", "data": "no key"}').alias("value"))
    backup = events.select(
        F.col("event_id").cast("string").alias("city"), F.lit("2024-02-01").alias("date"),
        F.when(F.col("event_type") == "view", "-").otherwise(F.col("user_id").cast("string")).alias("aqi"),
        F.col("value").cast("string").alias("pm25"), (F.col("value") / 2).cast("string").alias("no2"))
    ingest.land_stations(failed, root, backup)
    return landing.read_zone_table(spark, root, ingest.STATION_TABLE)


@registry.query("""
SELECT CAST(event_id AS VARCHAR) AS city, DATE '2024-02-01' AS date,
       CASE WHEN event_type = 'view' THEN '-' ELSE CAST(user_id AS VARCHAR) END AS aqi,
       CASE WHEN event_type <> 'click' THEN value END AS pm25,
       CAST(NULL AS DOUBLE) AS pm10, value AS no2
FROM events WHERE event_type <> 'error'
""")
def station_payloads(spark, sf_dir):
    """Each event as one station payload; errors carry a text instead of an object."""
    aqi = F.when(F.col("event_type") == "view", "-").otherwise(F.col("user_id").cast("string"))
    point = F.struct(F.col("value").alias("v"))
    iaqi = F.struct(F.when(F.col("event_type") != "click", point).alias("pm25"),
                    point.alias("no2"))
    ok = F.to_json(F.struct(
        F.lit("ok").alias("status"), F.struct(aqi.alias("aqi"), iaqi.alias("iaqi")).alias("data")))
    raw = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("city"),
        F.when(F.col("event_type") != "error", ok)
        .otherwise(F.lit('{"status": "error", "data": "Unknown station"}')).alias("value"))
    return payloads.station_readings(raw, day=F.lit("2024-02-01").cast("date"))


@registry.query("""
SELECT c_name AS city, CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
       DATE '2024-01-01' AS date, c_acctbal AS temperature_2m_mean FROM customer
""")
def ingest_weather_whole_backup(spark, sf_dir):
    """One payload that cannot be read is enough: all of the backup lands, nothing of the payloads."""
    root = fresh_path(spark, "ingest")
    backup = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("city"), F.lit("2024-01-01").alias("date"),
        F.col("c_acctbal").cast("string").alias("temperature_2m_mean"))
    ingest.land_weather(_weather_raw(spark, sf_dir), root, backup, backup_if="any")
    return landing.read_zone_table(spark, root, ingest.WEATHER_TABLE)


def mixed_topic(spark, sf_dir):
    """Posts, heartbeats and broken messages made from the events."""
    kind = F.col("event_type")
    post = F.to_json(F.struct(F.lit("POST").alias("message_type"),
                              F.col("event_id").cast("string").alias("id"),
                              F.col("user_id").alias("score")))
    beat = F.to_json(F.struct(F.lit("HEARTBEAT").alias("message_type"),
                              F.col("user_id").alias("random_val")))
    value = (F.when(kind == "error", beat).when(kind == "signup", "[1, 2]")
             .when(kind == "purchase", F.concat(F.lit("{bad "), F.col("event_id")))
             .otherwise(post))
    return table(spark, sf_dir, "events").select(value.alias("value"))


@registry.query("""
SELECT CASE event_type WHEN 'error' THEN 'HEARTBEAT' WHEN 'signup' THEN 'rejected'
       WHEN 'purchase' THEN 'rejected' ELSE 'POST' END AS message_type,
       count(*) AS n, CAST(coalesce(sum(CASE WHEN event_type IN ('view', 'click') THEN user_id END),
       0) AS BIGINT) AS score
FROM events GROUP BY 1
""")
def route_messages(spark, sf_dir):
    decoded = messages.decode(mixed_topic(spark, sf_dir), messages.FORUM_SCHEMA)
    good = messages.well_formed(decoded).select("message_type", "score")
    bad = messages.rejected(decoded).select(
        F.lit("rejected").alias("message_type"), F.lit(None).cast("bigint").alias("score"))
    return good.unionByName(bad).groupBy("message_type").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("score"), F.lit(0)).alias("score"))


@registry.query("""
SELECT event_id AS id, user_id AS score FROM events WHERE event_type IN ('view', 'click')
""")
def forum_posts_only(spark, sf_dir):
    decoded = messages.decode(mixed_topic(spark, sf_dir), messages.FORUM_SCHEMA)
    posts = messages.of_type(messages.well_formed(decoded), "POST")
    return posts.select(F.col("id").cast("bigint").alias("id"), "score")


@registry.query("""
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_type <> 'click' THEN user_id END AS score,
       CASE WHEN event_type <> 'view' THEN value END AS created_utc, event_type AS title
FROM events
""")
def mistyped_messages(spark, sf_dir):
    """Fields of another type than the schema's are missing; the other fields and the message stay."""
    kind, score = F.col("event_type"), F.col("user_id").cast("string")
    at = F.when(kind == "view", F.lit('"soon"')).otherwise(F.to_json(F.array("value")))
    at = F.when(kind == "view", at).otherwise(F.regexp_replace(at, r"[\[\]]", ""))
    value = F.concat(
        F.lit('{"message_type": "POST", "id": "'), F.col("event_id"), F.lit('", "score": '),
        F.when(kind == "click", F.concat(F.lit('{"up": '), score, F.lit("}"))).otherwise(score),
        F.lit(', "created_utc": '), at, F.lit(', "title": "'), kind, F.lit('"}'))
    sent = table(spark, sf_dir, "events").select(value.alias("value"))
    decoded = messages.well_formed(messages.decode(sent, messages.FORUM_SCHEMA))
    return decoded.select("id", "score", "created_utc", "title")


@registry.query("SELECT CAST(event_id AS VARCHAR) AS id, props AS title, user_id AS score FROM events")
def message_round_trip(spark, sf_dir):
    """Rows encoded as message values and decoded again."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("props").alias("title"),
        F.col("user_id").alias("score"))
    decoded = messages.decode(messages.as_kafka_values(rows), messages.FORUM_SCHEMA)
    return messages.well_formed(decoded).select("id", "title", "score")
