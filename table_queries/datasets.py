"""The cleaning plans and marts, fed with raw text tables made from the driver tables.

Each ``_raw_*`` function gives a table as it would land: all columns text, with bad
values, odd spellings and repeated keys.
"""

import uuid

from pyspark.sql import functions as F

from table_queries.registry import Registry, table
from table_queries.relations import COUNTRY_SQL, spelled_country
from terravane.operators import aggregates
from terravane.plans import audit, cleaning, flow, marts, quality
from terravane.plans import registry as plan_registry
from terravane.sources import landing, zones
from terravane.staging import fresh_path

registry = Registry()


def _text(c):
    return c.cast("string")


def _choose(column, **cases):
    """CASE column WHEN ... END with an ``other`` branch."""
    other = cases.pop("other", None)
    out = F.lit(other)
    for value, result in cases.items():
        out = F.when(F.col(column) == value, F.lit(result)).otherwise(out)
    return out


# ---- current air quality --------------------------------------------------------------

def _raw_stations(spark, sf_dir):
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        _choose("event_type", click=" Paris ", view="Tokyo", purchase="Atlantis",
                signup="New York\t", other="Cairo").alias("city"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.when(value > 90, "-").otherwise(_text(value)).alias("aqi"),
        F.when(value < 1, "-1").otherwise(_text(value)).alias("pm25"),
        F.get_json_object("props", "$.k").alias("pm10"),
        _text(F.col("user_id")).alias("no2"))


_STATIONS_SQL = """
SELECT s.event_id, city AS "City", iso AS "CountryISO", dt AS "DateTime",
       CAST(year(dt) AS INTEGER) AS "Year", aqi, pm25, pm10, no2
FROM (SELECT *, row_number() OVER (PARTITION BY city, dt ORDER BY event_id) AS rn FROM (
        SELECT event_id, CASE event_type WHEN 'click' THEN 'Paris' WHEN 'view' THEN 'Tokyo'
                   WHEN 'purchase' THEN 'Atlantis' WHEN 'signup' THEN 'New York' ELSE 'Cairo' END AS city,
               CAST(CAST(ts AS DATE) AS TIMESTAMP) AS dt,
               CASE WHEN value <= 90 THEN value END AS aqi,
               CASE WHEN value < 1 THEN -1 ELSE value END AS pm25,
               CAST(json_extract(props, '$.k') AS DOUBLE) AS pm10, CAST(user_id AS DOUBLE) AS no2
        FROM events)) s
LEFT JOIN (VALUES ('Paris', 'FRA'), ('Tokyo', 'JPN'), ('New York', 'USA'), ('Cairo', 'EGY'))
     AS c(name, iso) ON city = name
WHERE rn = 1 AND aqi >= 0 AND pm25 >= 0 AND pm10 >= 0 AND no2 >= 0
"""


def _clean_stations(spark, sf_dir):
    return cleaning.clean_current_air_quality(_raw_stations(spark, sf_dir), ["event_id"])


@registry.query(_STATIONS_SQL)
def clean_current_air_quality(spark, sf_dir):
    return _as_oracle(_clean_stations(spark, sf_dir))


def _as_oracle(df):
    """Timestamps without a zone, as in the SQL result."""
    stamps = [c for c, t in df.dtypes if t == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


# ---- historical weather ---------------------------------------------------------------

def _raw_weather(spark, sf_dir):
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss'+00:00'").alias("date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", " Paris")
        .when(F.col("o_orderpriority") == "2-HIGH", "Lima ")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Oslo")
        .when(F.col("o_orderpriority") == "5-LOW", "Cape Town")
        .otherwise("Atlantis").alias("city"),
        _text(price / 5000).alias("latitude"),
        _text(price / 2000 - 50).alias("longitude"),
        _text(price / 1000 - 300).alias("AverageTemperature"),
        _text(price / 100000 - 1).alias("AverageTemperatureUncertainty"))


_WEATHER_SQL = """
SELECT o_orderkey, city AS "City", iso AS "CountryISO", o_orderdate AS "DateTime",
       CAST(year(o_orderdate) AS INTEGER) AS "Year",
       CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS "Latitude",
       CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS "Longitude",
       CASE WHEN temp >= -273.15 THEN temp END AS "AverageTemperature",
       CASE WHEN unc >= 0 THEN unc END AS "AverageTemperatureUncertainty"
FROM (SELECT *, row_number() OVER (PARTITION BY city, o_orderdate ORDER BY o_orderkey) AS rn FROM (
        SELECT o_orderkey, o_orderdate,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Paris' WHEN '2-HIGH' THEN 'Lima'
                   WHEN '3-MEDIUM' THEN 'Oslo' WHEN '5-LOW' THEN 'Cape Town' ELSE 'Atlantis' END AS city,
               o_totalprice / 5000 AS lat, o_totalprice / 2000 - 50 AS lon,
               o_totalprice / 1000 - 300 AS temp, o_totalprice / 100000 - 1 AS unc
        FROM orders))
LEFT JOIN (VALUES ('Paris', 'FRA'), ('Lima', 'PER'), ('Oslo', 'NOR'), ('Cape Town', 'ZAF'))
     AS c(name, iso) ON city = name
WHERE rn = 1
"""


def _clean_weather(spark, sf_dir):
    return cleaning.clean_historical_weather(_raw_weather(spark, sf_dir), ["o_orderkey"])


@registry.query(_WEATHER_SQL)
def clean_historical_weather(spark, sf_dir):
    return _as_oracle(_clean_weather(spark, sf_dir))


# ---- environment trends ---------------------------------------------------------------

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _raw_trends(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *LINE_ORDER,
        _text(F.year("l_shipdate")).alias("Year"),
        _choose("l_returnflag", A="'UK'", R=" South Africa ", other="Elbonia").alias("Country"),
        _text(F.col("l_quantity") - 20).alias("Avg_Temperature_degC"),
        _text(F.col("l_discount") - 0.02).alias("CO2_Emissions_tons_per_capita"),
        _text(F.col("l_tax")).alias("Sea_Level_Rise_mm"),
        _text(F.col("l_extendedprice")).alias("Rainfall_mm"),
        _text(F.col("l_partkey") * 1000).alias("Population"),
        _text(F.col("l_quantity") * 2.5).alias("Renewable_Energy_pct"),
        _text(F.col("l_linenumber") - 2).alias("Extreme_Weather_Events"),
        _text(F.col("l_suppkey")).alias("Forest_Area_pct"))


def _trends_sql(key):
    return f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, y AS "Year",
       country AS "Country", iso AS "CountryISO", temp AS "Avg_Temperature_degC",
       CASE WHEN co2 >= 0 THEN co2 END AS "CO2_Emissions_tons_per_capita",
       l_tax AS "Sea_Level_Rise_mm", l_extendedprice AS "Rainfall_mm", pop AS "Population",
       ren AS "Renewable_Energy_pct",
       CASE WHEN ev >= 0 THEN ev END AS "Extreme_Weather_Events", forest AS "Forest_Area_pct"
FROM (SELECT *, row_number() OVER (PARTITION BY y, {key} ORDER BY l_orderkey, l_linenumber,
          l_partkey, l_suppkey, l_extendedprice) AS rn FROM (
        SELECT *, year(l_shipdate) AS y,
               CASE l_returnflag WHEN 'A' THEN 'UK' WHEN 'R' THEN 'South Africa' ELSE 'Elbonia' END AS country,
               CASE l_returnflag WHEN 'A' THEN 'GBR' WHEN 'R' THEN 'ZAF' END AS iso,
               l_quantity - 20 AS temp, l_discount - CAST(0.02 AS DOUBLE) AS co2,
               l_partkey * 1000 AS pop, l_quantity * CAST(2.5 AS DOUBLE) AS ren,
               CAST(l_linenumber - 2 AS BIGINT) AS ev, CAST(l_suppkey AS DOUBLE) AS forest
        FROM lineitem))
WHERE rn = 1 AND temp BETWEEN -100 AND 60 AND forest BETWEEN 0 AND 100 AND ren BETWEEN 0 AND 100
  AND pop BETWEEN 0 AND 1000000000000 AND l_extendedprice >= 0
"""


@registry.query(_trends_sql("iso"))
def clean_environment_trends(spark, sf_dir):
    return cleaning.clean_environment_trends(_raw_trends(spark, sf_dir), LINE_ORDER)


@registry.query(_trends_sql("iso, CASE WHEN iso IS NULL THEN l_suppkey END"))
def clean_trends_by_name(spark, sf_dir):
    """The same plan with a second key for the rows without a country code."""
    return cleaning.clean_environment_trends(
        _raw_trends(spark, sf_dir), LINE_ORDER, dedup_fallback_key="l_suppkey")


# ---- land temperature by city ---------------------------------------------------------

def _raw_land(spark, sf_dir):
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", "bad")
        .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("dt"),
        _text(value - 10).alias("AverageTemperature"),
        _text(value - 5).alias("AverageTemperatureUncertainty"),
        F.concat(F.lit(" town "), "user_id").alias("City"),
        _choose("event_type", click="SOUTH KOREA", view=" ivory coast ", purchase="kosovo",
                other="france").alias("Country"),
        F.concat(_text(value / 2), _choose("event_type", view="S", other="n")).alias("Latitude"),
        F.concat(_text(value), F.lit("W")).alias("Longitude"))


@registry.query("""
SELECT event_id, CAST(d AS TIMESTAMP) AS "DateTime", CAST(year(d) AS INTEGER) AS "Year",
       CAST(CASE WHEN value - 10 BETWEEN -100 AND 60 THEN value - 10 END AS FLOAT) AS "AverageTemperature",
       CAST(CASE WHEN value - 5 >= 0 THEN value - 5 END AS FLOAT) AS "AverageTemperatureUncertainty",
       'Town ' || user_id AS "City", country AS "Country", iso AS "CountryISO",
       CAST(CASE WHEN event_type = 'view' THEN -1 ELSE 1 END * (value / 2) AS FLOAT) AS "Latitude",
       CAST(-value AS FLOAT) AS "Longitude"
FROM (SELECT *, row_number() OVER (PARTITION BY d, user_id, country ORDER BY event_id) AS rn FROM (
        SELECT *, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS d,
               CASE event_type WHEN 'click' THEN 'South Korea' WHEN 'view' THEN 'Ivory Coast'
                   WHEN 'purchase' THEN 'Kosovo' ELSE 'France' END AS country,
               CASE event_type WHEN 'click' THEN 'KOR' WHEN 'view' THEN 'CIV'
                   WHEN 'purchase' THEN NULL ELSE 'FRA' END AS iso
        FROM events))
WHERE rn = 1 AND d IS NOT NULL AND value / 2 BETWEEN -90 AND 90 AND value BETWEEN -180 AND 180
""")
def clean_city_land_temperature(spark, sf_dir):
    return _as_oracle(cleaning.clean_city_land_temperature(_raw_land(spark, sf_dir), ["event_id"]))


# ---- happiness ------------------------------------------------------------------------

def _raw_happiness(spark, sf_dir):
    bal = F.col("c_acctbal")
    once = table(spark, sf_dir, "customer").select(
        spelled_country(F.col("c_nationkey")).alias("Country  name"),
        F.col("c_name").alias("Source"),
        F.when(F.col("c_mktsegment") != "BUILDING", _text(bal / 1000)).alias("Ladder Score"),
        _text(bal / 900).alias("upperwhisker"),
        F.when(F.col("c_mktsegment") != "MACHINERY", _text(bal / 1100))
        .otherwise("n/a").alias("lowerwhisker"))
    return once.unionByName(once)


_HAPPINESS_SQL = f"""
WITH s AS (SELECT name AS country, iso, c_name,
             CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal / 1000 END AS score,
             c_acctbal / 900 AS hi,
             CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_acctbal / 1100 END AS lo
           FROM customer JOIN {COUNTRY_SQL} ON c_nationkey = k)
SELECT country, iso AS "CountryISO", c_name AS source,
       CAST(coalesce(score, (SELECT median(score) FROM s)) AS FLOAT) AS ladder_score,
       CAST(hi AS FLOAT) AS upperwhisker,
       CAST(coalesce(lo, (SELECT median(lo) FROM s)) AS FLOAT) AS lowerwhisker
FROM s WHERE lower(trim(country)) IS DISTINCT FROM 'kosovo'
"""


def _clean_happiness(spark, sf_dir):
    return cleaning.clean_happiness(_raw_happiness(spark, sf_dir))


@registry.query(_HAPPINESS_SQL)
def clean_happiness(spark, sf_dir):
    return _clean_happiness(spark, sf_dir)


@registry.query(f"""
SELECT 'happiness' AS dataset, rule, violations, n AS "rows" FROM (
  SELECT count(*) AS n,
         count(*) FILTER (ladder_score NOT BETWEEN 0 AND 10) AS ladder_score_outside_range,
         count(*) FILTER (lowerwhisker > upperwhisker) AS whiskers_crossed,
         count(*) FILTER (ladder_score NOT BETWEEN lowerwhisker AND upperwhisker)
             AS score_outside_whiskers
  FROM ({_HAPPINESS_SQL}))
UNPIVOT (violations FOR rule IN (ladder_score_outside_range, whiskers_crossed,
                                 score_outside_whiskers))
""")
def happiness_rule_report(spark, sf_dir):
    df = _clean_happiness(spark, sf_dir)
    return aggregates.rule_report(df, cleaning.happiness_rules(df), "happiness")


# ---- natural disasters ----------------------------------------------------------------

def _raw_disasters(spark, sf_dir):
    price, day = F.col("o_totalprice"), F.col("o_orderdate")
    low = F.col("o_orderpriority") == "5-LOW"
    once = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Dis No"),
        F.lit(" France ").alias("Country"),
        F.lit("FRA").alias("ISO"),
        F.col("o_orderpriority").alias("Disaster Type"),
        _choose("o_orderstatus", O="None", F=" Big FLOOD ", other="NaN").alias("Event Name"),
        _text(F.year(day)).alias("Start Year"),
        F.when(~low, _text(F.month(day))).alias("Start Month"),
        _text(F.dayofmonth(day) + 1).alias("Start Day"),
        _text(F.year(day)).alias("End Year"),
        F.when(F.col("o_orderstatus") != "O", _text(F.month(day))).alias("End Month"),
        F.lit("").alias("End Day"),
        _text(F.floor(price / 1000) - 100).alias("Total Deaths"),
        _text(price * 1000).alias("Total Damages USD"),
        _text(price / 5000).alias("Latitude"))
    return once.unionByName(once)


def _disasters_sql(end_month_default, end_date):
    return f"""
SELECT o_orderkey AS dis_no, 'france' AS country, lower(o_orderpriority) AS disaster_type,
       CASE o_orderstatus WHEN 'F' THEN 'big flood' END AS event_name,
       CAST(year(o_orderdate) AS VARCHAR) AS start_year, CAST(sm AS VARCHAR) AS start_month,
       CAST(day(o_orderdate) + 1 AS VARCHAR) AS start_day,
       CAST(year(o_orderdate) AS VARCHAR) AS end_year, CAST(em AS VARCHAR) AS end_month,
       '' AS end_day,
       CASE WHEN floor(o_totalprice / 1000) - 100 >= 0
            THEN CAST(floor(o_totalprice / 1000) - 100 AS DOUBLE) END AS total_deaths,
       o_totalprice * 1000 AS total_damages_usd,
       CAST(o_totalprice / 5000 AS FLOAT) AS "Latitude",
       sd AS "StartDate", CASE WHEN sd > ed THEN sd ELSE ed END AS "EndDate", 'FRA' AS "CountryISO"
FROM (SELECT *,
        CAST(try_cast(format('{{:04d}}-{{:02d}}-{{:02d}}', year(o_orderdate), coalesce(sm, 1),
                             day(o_orderdate) + 1) AS DATE) AS TIMESTAMP) AS sd,
        CAST({end_date} AS TIMESTAMP) AS ed
      FROM (SELECT *, CASE WHEN o_orderpriority <> '5-LOW' THEN month(o_orderdate) END AS sm,
                   CASE WHEN o_orderstatus <> 'O' THEN month(o_orderdate) END AS em FROM orders))
"""


@registry.query(_disasters_sql(1, "make_date(year(o_orderdate), coalesce(em, 1), 1)"))
def clean_natural_disasters(spark, sf_dir):
    return _as_oracle(cleaning.clean_natural_disasters(_raw_disasters(spark, sf_dir)))


@registry.query(_disasters_sql(12, "last_day(make_date(year(o_orderdate), coalesce(em, 12), 1))"))
def clean_disasters_period_end(spark, sf_dir):
    return _as_oracle(
        cleaning.clean_natural_disasters(_raw_disasters(spark, sf_dir), end_mode="end"))


# ---- air quality index ----------------------------------------------------------------

def _raw_index(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Row"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias(" Date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "france")
        .when(F.col("o_orderpriority") == "2-HIGH", " Peru")
        .when(F.col("o_orderpriority") == "3-MEDIUM", " Kosovo ")
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None))
        .otherwise("Norway").alias("Country "),
        F.when(F.col("o_orderstatus") == "P", "N/A")
        .otherwise(_text(F.col("o_totalprice") - 50000)).alias("AQI_Value"))


_INDEX_SQL = """
SELECT o_orderkey AS "Row", o_orderdate AS "DateTime",
       CAST(year(o_orderdate) AS INTEGER) AS "Year",
       CASE o_orderpriority WHEN '1-URGENT' THEN 'france' WHEN '2-HIGH' THEN ' Peru'
           WHEN '5-LOW' THEN NULL ELSE 'Norway' END AS "Country",
       CASE o_orderpriority WHEN '1-URGENT' THEN 'FRA' WHEN '2-HIGH' THEN 'PER'
           WHEN '5-LOW' THEN NULL ELSE 'NOR' END AS "CountryISO",
       o_totalprice - 50000 AS aqi
FROM orders
WHERE o_orderpriority <> '3-MEDIUM' AND o_orderstatus <> 'P' AND o_totalprice - 50000 >= 0
"""


def _clean_index(spark, sf_dir):
    return cleaning.clean_air_quality_index(_raw_index(spark, sf_dir))


@registry.query(_INDEX_SQL)
def clean_air_quality_index(spark, sf_dir):
    return _as_oracle(_clean_index(spark, sf_dir))


@registry.query(f"""SELECT * EXCLUDE ("Country"), "Country" AS "CountryName" FROM ({_INDEX_SQL})""")
def clean_index_strict_codes(spark, sf_dir):
    return _as_oracle(cleaning.clean_air_quality_index(
        _raw_index(spark, sf_dir), country_name="CountryName", strict_code=True))


# ---- country indicators ---------------------------------------------------------------

def _raw_indicators(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *LINE_ORDER,
        _choose("l_returnflag", A=" KOSOVO", R="Peru", other=None).alias("Country_Name"),
        F.concat(F.lit("s"), "l_suppkey").alias("Country_Code"),
        F.when(F.col("l_linestatus") == "O", _text(F.year("l_shipdate")))
        .otherwise(_text(F.year("l_shipdate") - 96)).alias("Time"),
        _text(F.col("l_quantity")).alias("Gini_index__SI_POV_GINI_"),
        F.when(F.col("l_tax") > 0.04, "..").otherwise(_text(-F.col("l_extendedprice")))
        .alias("Net_migration__SM_POP_NETM_"))


@registry.query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CASE WHEN l_returnflag = 'R' THEN 'Peru' END AS "CountryName",
       'S' || l_suppkey AS "CountryISO", y AS "Year", l_quantity AS "Gini_index__SI_POV_GINI_",
       CASE WHEN l_tax <= 0.04 THEN -l_extendedprice END AS "Net_migration__SM_POP_NETM_"
FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, y ORDER BY l_orderkey, l_linenumber,
          l_partkey, l_suppkey, l_extendedprice) AS rn
      FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN year(l_shipdate)
                           ELSE year(l_shipdate) - 96 END AS y FROM lineitem))
WHERE rn = 1 AND l_returnflag <> 'A' AND y BETWEEN 1900 AND 2025
""")
def clean_country_indicators(spark, sf_dir):
    return cleaning.clean_country_indicators(
        _raw_indicators(spark, sf_dir), LINE_ORDER, this_year=2025)


@registry.query("""
SELECT 'country_indicators' AS dataset, 'nulls' AS "check", item, n FROM (
  SELECT count(*) FILTER (l_returnflag = 'N') AS "CountryName", 0::BIGINT AS "CountryISO", 0::BIGINT AS "Year",
         0::BIGINT AS "Gini_index__SI_POV_GINI_", count(*) FILTER (l_tax > 0.04) AS "Net_migration__SM_POP_NETM_"
  FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, y ORDER BY l_orderkey, l_linenumber,
            l_partkey, l_suppkey, l_extendedprice) AS rn
        FROM (SELECT *, CASE WHEN l_linestatus = 'O' THEN year(l_shipdate)
                             ELSE year(l_shipdate) - 96 END AS y FROM lineitem))
  WHERE rn = 1 AND l_returnflag <> 'A' AND y BETWEEN 1900 AND 2025)
UNPIVOT (n FOR item IN ("CountryName", "CountryISO", "Year", "Gini_index__SI_POV_GINI_", "Net_migration__SM_POP_NETM_"))
""")
def indicator_nulls(spark, sf_dir):
    """What is missing in the cleaned indicators, stored as floats."""
    cleaned = cleaning.clean_country_indicators(
        _raw_indicators(spark, sf_dir), LINE_ORDER, this_year=2025, float32=True)
    return audit.missing_values("country_indicators", cleaned.drop(*LINE_ORDER))


# ---- quality reports ------------------------------------------------------------------

@registry.query("""
SELECT 'historical_weather' AS dataset, rule, violations, n AS "rows" FROM (
  SELECT count(*) AS n, count(*) FILTER (o_orderdate IS NULL) AS date_unparsed,
         count(*) FILTER (o_totalprice / 100000 - 1 < 0) AS uncertainty_negative,
         count(*) FILTER (o_totalprice / 1000 - 300 < -273.15) AS temperature_below_absolute_zero,
         count(*) FILTER (o_totalprice / 5000 NOT BETWEEN -90 AND 90) AS latitude_outside_range,
         count(*) FILTER (o_totalprice / 2000 - 50 NOT BETWEEN -180 AND 180) AS longitude_outside_range
  FROM orders)
UNPIVOT (violations FOR rule IN (date_unparsed, uncertainty_negative,
    temperature_below_absolute_zero, latitude_outside_range, longitude_outside_range))
""")
def weather_quality(spark, sf_dir):
    return quality.quality_report("historical_weather", _raw_weather(spark, sf_dir))


@registry.query("""
SELECT 'globallandtemperaturesbymajorcity' AS dataset, rule, violations, n AS "rows" FROM (
  SELECT count(*) AS n, count(*) FILTER (event_type = 'error') AS date_unparsed,
         0 AS latitude_unparsed, 0 AS longitude_unparsed,
         count(*) FILTER (value / 2 NOT BETWEEN -90 AND 90) AS latitude_outside_range,
         count(*) FILTER (value NOT BETWEEN -180 AND 180) AS longitude_outside_range,
         count(*) FILTER (value - 10 NOT BETWEEN -100 AND 60) AS temperature_outside_range,
         count(*) FILTER (value - 5 < 0) AS uncertainty_negative
  FROM events)
UNPIVOT (violations FOR rule IN (date_unparsed, latitude_unparsed, longitude_unparsed,
    latitude_outside_range, longitude_outside_range, temperature_outside_range,
    uncertainty_negative))
""")
def land_temperature_quality(spark, sf_dir):
    return quality.quality_report("GlobalLandTemperaturesByMajorCity", _raw_land(spark, sf_dir))


@registry.query("""
SELECT 'natural_disaster_database' AS dataset, rule, violations, n AS "rows" FROM (
  SELECT 2 * count(*) AS n,
         2 * count(*) FILTER (floor(o_totalprice / 1000) - 100 < 0) AS total_deaths_negative,
         2 * count(*) FILTER (sd > ed) AS start_after_end
  FROM (SELECT o_totalprice,
          try_cast(format('{:04d}-{:02d}-{:02d}', year(o_orderdate),
              CASE WHEN o_orderpriority <> '5-LOW' THEN month(o_orderdate) ELSE 1 END,
              day(o_orderdate) + 1) AS DATE) AS sd,
          make_date(year(o_orderdate),
              CASE WHEN o_orderstatus <> 'O' THEN month(o_orderdate) ELSE 1 END, 1) AS ed
        FROM orders))
UNPIVOT (violations FOR rule IN (total_deaths_negative, start_after_end))
""")
def disaster_quality(spark, sf_dir):
    return quality.quality_report("natural_disaster_database", _raw_disasters(spark, sf_dir))


# ---- registry and marts ---------------------------------------------------------------

@registry.query(f"""
SELECT 'air_quality_index_2' AS name, count(*) AS n FROM ({_INDEX_SQL})
UNION ALL SELECT 'world_hapiness_scores', count(*) FROM ({_HAPPINESS_SQL})
UNION ALL SELECT 'other_table', count(*) FROM part
""")
def clean_by_name(spark, sf_dir):
    cleaned = plan_registry.clean_all({
        "Air_Quality_Index_2": _raw_index(spark, sf_dir),
        "world_hapiness_scores": _raw_happiness(spark, sf_dir),
        "Other_Table": table(spark, sf_dir, "part"),
    })
    counts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
              for name, df in cleaned.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@registry.query(f"""
SELECT a.event_id, a."City", a."CountryISO", a.aqi, h.country, h.source, h.ladder_score
FROM ({_STATIONS_SQL}) a JOIN ({_HAPPINESS_SQL}) h
  ON a."CountryISO" IS NOT DISTINCT FROM h."CountryISO"
""")
def mart_air_happiness(spark, sf_dir):
    mart = marts.air_quality_happiness(_clean_stations(spark, sf_dir), _clean_happiness(spark, sf_dir))
    return mart.select("event_id", "City", "CountryISO", "aqi", "country", "source", "ladder_score")


@registry.query(f"""
SELECT w.o_orderkey, i."Row", w."City", w."CountryISO", w."DateTime", w."Year" AS "Year_x",
       i."Year" AS "Year_y", i.aqi, w."AverageTemperature"
FROM ({_WEATHER_SQL}) w JOIN ({_INDEX_SQL}) i
  ON w."CountryISO" IS NOT DISTINCT FROM i."CountryISO" AND w."DateTime" = i."DateTime"
WHERE w."Year" BETWEEN 1996 AND 1999
""")
def mart_weather_index(spark, sf_dir):
    mart = marts.weather_air_index(
        _clean_weather(spark, sf_dir), _clean_index(spark, sf_dir), 1996, 1999)
    return _as_oracle(mart.select("o_orderkey", "Row", "City", "CountryISO", "DateTime",
                                  "Year_x", "Year_y", "aqi", "AverageTemperature"))


@registry.query(f"""
SELECT a."City", a."CountryISO", a."DateTime", a.aqi, h.country, h.source, h.ladder_score
FROM ({_STATIONS_SQL}) a JOIN ({_HAPPINESS_SQL}) h
  ON a."CountryISO" IS NOT DISTINCT FROM h."CountryISO"
""")
def landing_to_mart(spark, sf_dir):
    """The whole flow: CSV files, landing zone, trusted zone, exploitation zone, mart."""
    root, mark = fresh_path(spark, "flow"), uuid.uuid4().hex[:12]
    raw = {"Current_air_quality_data": _raw_stations(spark, sf_dir).orderBy("event_id"),
           "world_hapiness_scores": _raw_happiness(spark, sf_dir).withColumnRenamed(
               "Country  name", "Country name")}
    for name, df in raw.items():
        df.write.option("header", True).csv(f"{root}/csv/{name}")
        landing.land_csv(spark, f"{root}/csv/{name}", f"{root}/lake", name)
    trusted, served = f"trusted_{mark}", f"served_{mark}"
    for zone in (trusted, served):
        zones.create_zone(spark, zone, f"{root}/{zone}")
    flow.run_all(spark, f"{root}/lake", trusted, served)
    mart = zones.read_tables(spark, served)[marts.AIR_HAPPINESS_MART]
    return _as_oracle(mart.select(
        "City", "CountryISO", "DateTime", "aqi", "country", "source", "ladder_score"))


@registry.query(f"""
SELECT 'current_air_quality_data' AS dataset, "check", item, n FROM (
  SELECT 'rows' AS "check", CAST(NULL AS VARCHAR) AS item, count(*) AS n FROM events
  UNION ALL SELECT 'repeated', NULL, CAST(sum(c - 1) AS BIGINT) FROM (
      SELECT count(*) AS c FROM events GROUP BY CAST(ts AS DATE),
          CASE WHEN event_type IN ('click', 'view', 'purchase', 'signup') THEN event_type END)
  UNION ALL SELECT 'name_unmatched', "City", count(*) FROM ({_STATIONS_SQL}) WHERE "CountryISO" IS NULL
      GROUP BY 2)
UNION ALL
SELECT 'air_quality_index', "check", item, n FROM (
  SELECT 'rows' AS "check", CAST(NULL AS VARCHAR) AS item, count(*) AS n FROM orders
  UNION ALL SELECT 'name_unmatched', "Country", count(*) FROM ({_INDEX_SQL}) WHERE "CountryISO" IS NULL
      GROUP BY 2)
UNION ALL
SELECT 'globallandtemperaturesbymajorcity', 'date_unparsed', 'bad',
       count(*) FROM events WHERE event_type = 'error' HAVING count(*) > 0
""")
def flow_audit(spark, sf_dir):
    """Rows, repeats, unmatched names of the station and index tables, unparsed dates of land."""
    raw = {"Current_air_quality_data": _raw_stations(spark, sf_dir),
           "air_quality_index": _raw_index(spark, sf_dir)}
    counted = audit.flow_audit(raw, {"current_air_quality_data": _clean_stations(spark, sf_dir),
                                     "air_quality_index": _clean_index(spark, sf_dir)})
    land = _raw_land(spark, sf_dir)
    dates = audit.dataset_audit(
        "GlobalLandTemperaturesByMajorCity", land,
        cleaning.clean_city_land_temperature(land, ["event_id"]))
    return counted.unionByName(dates.filter("check = 'date_unparsed'"))
