from datetime import datetime

import pytest
from pyspark.sql import functions as F

from terravane.operators import aggregates
from terravane.plans import cleaning, marts, quality, registry, reports
from tests.helpers import frame, plan, rows, text_frame

DAY = datetime(2024, 1, 1)


def clean(spark, fn, columns, *data, **options):
    return fn(text_frame(spark, *data, columns=columns), order_by=["_i"], **options)


# ---- current air quality ----

def test_invalid_first_reading_removes_its_key(spark):
    df = clean(spark, cleaning.clean_current_air_quality, "city date aqi pm25 pm10 no2",
               ("Paris", "2024-01-01", "-", "1", "1", "1"),
               (" Paris ", "2024-01-01", "5", "1", "1", "1"),
               ("Lima", "2024-01-01", "7", "1", "2", "0"),
               ("Lima", "2024-01-01", "8", "1", "2", "0"),
               ("Atlantis", "2024-01-01", "9", "1", "2", "3"),
               ("Oslo", "2024-01-01", "9", "-1", "2", "3"),
               ("Rome", "2024-01-01", "9", None, "2", "3"))
    got = df.select("City", "CountryISO", "DateTime", "Year", "aqi", "pm25", "pm10", "no2")
    assert rows(got, "City") == [
        ("Atlantis", None, DAY, 2024, 9.0, 1.0, 2.0, 3.0),
        ("Lima", "PER", DAY, 2024, 7.0, 1.0, 2.0, 0.0)]
    assert "date" not in df.columns and "city" not in [c for c in df.columns if c != "City"]


def test_typed_landing_columns_are_accepted(spark):
    df = frame(spark, "city string, date date, aqi double, pm25 double, pm10 double, no2 int, o int",
               ("Paris", DAY.date(), 5.0, float("nan"), 1.0, 1, 1),
               ("Rome", DAY.date(), 5.0, 0.0, 1.0, 1, 2))
    got = cleaning.clean_current_air_quality(df, ["o"])
    assert rows(got.select("City", "DateTime", "no2")) == [("Rome", DAY, 1.0)]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="pm25"):
        cleaning.clean_current_air_quality(text_frame(spark, ("a",), columns="city"))


# ---- historical weather ----

def test_weather_values_out_of_range_become_missing(spark):
    df = clean(spark, cleaning.clean_historical_weather,
               "date city latitude longitude AverageTemperature AverageTemperatureUncertainty",
               ("2024-01-01", " Paris", "91", "180", "-273.16", "-0.1"),
               ("2024-01-01", "Paris ", "1", "1", "1", "1"),
               ("2024-01-02", "Paris", "-90", "-180.5", "-273.15", "0"),
               ("bad", None, "x", "1", "2", "3"), ("worse", None, "1", "1", "2", "3"))
    got = df.select("City", "CountryISO", F.col("DateTime").cast("date").cast("string"), "Year",
                    "Latitude", "Longitude", "AverageTemperature",
                    "AverageTemperatureUncertainty")
    assert rows(got, F.col("DateTime").asc_nulls_last()) == [
        ("Paris", "FRA", "2024-01-01", 2024, None, 180.0, None, None),
        ("Paris", "FRA", "2024-01-02", 2024, -90.0, None, -273.15, 0.0),
        (None, None, None, None, None, 1.0, 2.0, 3.0)]


def test_weather_without_optional_columns(spark):
    df = frame(spark, "date timestamp, temperature_2m_mean float, city string, o int",
               (DAY, 5.5, "Oslo", 1))
    got = cleaning.clean_historical_weather(df, ["o"])
    assert rows(got.select("City", "CountryISO", "DateTime", "Year", "temperature_2m_mean")) == [
        ("Oslo", "NOR", DAY, 2024, 5.5)]
    bare = cleaning.clean_historical_weather(frame(spark, "city string", ("Oslo",)))
    assert rows(bare.select("City", "DateTime", "Year")) == [("Oslo", None, None)]


# ---- environment trends ----

TRENDS = "Year Country Avg_Temperature_degC Population Renewable_Energy_pct Forest_Area_pct Rainfall_mm"
VALUES = ("10", "1000", "50", "50", "3")


def test_unlisted_countries_collapse_per_year(spark):
    data = [("2020", "Elbonia", *VALUES), ("2020", "Gondor", *VALUES), ("2020", "UK", *VALUES),
            ("2020", " 'UK' ", *VALUES), ("2021", "Gondor", *VALUES)]
    df = clean(spark, cleaning.clean_environment_trends, TRENDS, *data)
    assert rows(df.select("Year", "Country", "CountryISO"), "_i") == [
        (2020, "Elbonia", None), (2020, "UK", "GBR"), (2021, "Gondor", None)]
    apart = clean(spark, cleaning.clean_environment_trends, TRENDS, *data,
                  dedup_fallback_key="Country")
    assert apart.count() == 4


def test_trend_rows_out_of_range_are_dropped(spark):
    good = ("2020", "UK", *VALUES)
    cases = {2: "61", 3: "1000.5", 4: "100.1", 5: None, 6: "-1"}
    for place, bad in cases.items():
        row = tuple(bad if i == place else v for i, v in enumerate(good))
        assert clean(spark, cleaning.clean_environment_trends, TRENDS, row).count() == 0
    kept = clean(spark, cleaning.clean_environment_trends, TRENDS, good)
    assert dict(kept.dtypes)["Population"] == "bigint" and kept.count() == 1


# ---- land temperature by city ----

def test_land_temperature(spark):
    columns = "dt AverageTemperature AverageTemperatureUncertainty City Country Latitude Longitude"
    df = clean(spark, cleaning.clean_city_land_temperature, columns,
               ("2000-01-01", "10.5", "-1", " são paulo", "brazil", "23.55s", "46.64W"),
               ("2000-01-01", "99", "2", " são paulo", "brazil", "23.55S", "46.64W"),
               ("2000-01-01", "61", "2", "abidjan", "IVORY COAST", "5.6N", "3.2W"),
               ("bad", "1", "1", "x", "y", "1N", "1E"),
               ("2000-01-01", "1", "1", "x", "y", "91N", "1E"),
               ("2000-01-01", "1", "1", "z", "y", "N", "1E"))
    got = df.select("City", "Country", "CountryISO", "Year", "AverageTemperature",
                    "AverageTemperatureUncertainty", F.round("Latitude", 2), F.round("Longitude", 2))
    assert [tuple(r)[:6] for r in got.orderBy("City").collect()] == [
        ("Abidjan", "Ivory Coast", "CIV", 2000, None, 2.0),
        ("São Paulo", "Brazil", "BRA", 2000, 10.5, None)]
    assert dict(df.dtypes)["Latitude"] == "float" and "dt" not in df.columns
    listed = clean(spark, cleaning.clean_city_land_temperature, columns,
                   ("2000-01-01", "1", "1", "paris", "France", "48N", "2E"), listed_codes=True)
    assert rows(listed.select("City", "Country", "CountryISO")) == [("Paris", "France", None)]


# ---- happiness ----

def happiness(spark, *data):
    raw = text_frame(spark, *data, columns="Name Ladder Low Up").drop("_i")
    return raw.toDF("Country name", "Ladder score", "lowerwhisker", "upperwhisker")


def test_medians_are_taken_before_kosovo_is_removed(spark):
    raw = happiness(spark, ("France", "1", "0", "2"), ("france ", "2", "0", "9"),
                    (" KOSOVO", "9", "0", "9"), ("Peru", None, "5", "4"),
                    ("France", "1", "0", "2"), (None, "x", "0", "99"))
    df = cleaning.clean_happiness(raw)
    assert df.columns == ["country", "CountryISO", "ladder_score", "lowerwhisker", "upperwhisker"]
    assert rows(df.select("country", "CountryISO", "ladder_score"),
                F.col("country").asc_nulls_first()) == [
        (None, None, 2.0), ("France", "FRA", 1.0), ("Peru", "PER", 2.0), ("france ", "FRA", 2.0)]
    report = aggregates.rule_report(df, cleaning.happiness_rules(df), "h")
    assert rows(report.select("rule", "violations"), "rule") == [
        ("ladder_score_outside_range", 0), ("score_outside_whiskers", 1), ("whiskers_crossed", 1)]
    close = cleaning.clean_happiness(raw, exact=False)
    assert close.count() == 4


def test_only_known_columns_become_numbers(spark):
    raw = text_frame(spark, ("France", "5", "7"), columns="country ladder_score other").drop("_i")
    df = cleaning.clean_happiness(raw)
    assert dict(df.dtypes) == {"country": "string", "CountryISO": "string",
                               "ladder_score": "float", "other": "string"}


# ---- natural disasters ----

DISASTER = ("iso country start_year start_month start_day end_year end_month end_day "
            "no_injured total_damages_usd latitude longitude disaster_type")


def test_disasters(spark):
    data = [("FRA", " France", "2020", "3", "5", "2020", None, None, "-1", "16777217", "1.5", "2", "None"),
            ("FRA", " France", "2020", "3", "5", "2020", None, None, "-1", "16777217", "1.5", "2", "None"),
            ("PER", "Peru", "2020", None, None, "2020", "2", "", "4", "x", None, "2", " Flood ")]
    raw = text_frame(spark, *data, columns=DISASTER).drop("_i").toDF(
        *[c.replace("_", " ").title() for c in DISASTER.split()])
    df = cleaning.clean_natural_disasters(raw)
    assert df.columns[-1] == "CountryISO" and "Latitude" in df.columns
    got = df.select("country", "StartDate", "EndDate", "no_injured", "total_damages_usd",
                    "disaster_type")
    assert rows(got, "country") == [
        ("france", datetime(2020, 3, 5), datetime(2020, 3, 5), None, 16777217.0, None),
        ("peru", datetime(2020, 1, 1), datetime(2020, 2, 1), 4.0, None, "flood")]
    end = cleaning.clean_natural_disasters(raw, end_mode="end")
    assert rows(end.select("EndDate"), "EndDate") == [
        (datetime(2020, 2, 29),), (datetime(2020, 12, 31),)]


# ---- air quality index ----

@pytest.mark.parametrize("header", ["AQI Value", "AQI_Value"])
def test_air_quality_index(spark, header):
    raw = text_frame(spark, ("2024-01-01", "france", "5"), ("2024-01-01", " Kosovo ", "5"),
                     ("2024-01-01", "kosovo", "1"), ("bad", None, "7"), ("2024-01-01", "Peru", "-1"),
                     ("2024-01-01", "Peru", "N/A"), columns="Date Country v")
    raw = raw.drop("_i").toDF(" Date", "Country ", header)
    df = cleaning.clean_air_quality_index(raw)
    assert rows(df.select("Country", "CountryISO", "DateTime", "Year", "aqi"), "aqi") == [
        ("kosovo", None, DAY, 2024, 1.0), ("france", "FRA", DAY, 2024, 5.0),
        (None, None, None, None, 7.0)]
    assert "CountryName" in cleaning.clean_air_quality_index(
        raw, country_name="CountryName", strict_code=True).columns


# ---- country indicators ----

@pytest.mark.parametrize("landed", [True, False])
def test_country_indicators(spark, landed):
    raw = text_frame(spark, ("Peru", "per", "2000", "YR2000", "5"), ("Peru", "per", "2000", "x", "6"),
                     ("Kosovo ", "xkx", "2000", "x", "1"), (None, "abc", "1899", "x", "1"),
                     (None, "abc", "2020", "x", ".."), columns="a b c d e")
    headers = ["Country Name", "Country Code", "Time", "Time Code", "Gini index [SI.POV.GINI]"]
    df = raw.toDF("_i", *headers)
    if landed:
        from terravane.functions.names import landed_name

        df = raw.toDF("_i", *[landed_name(h) for h in headers])
    got = cleaning.clean_country_indicators(df, ["_i"], this_year=2025)
    gini = got.columns[-1]
    assert rows(got.select("CountryName", "CountryISO", "Year", F.col(f"`{gini}`")), "Year") == [
        ("Peru", "PER", 2000, 5.0), (None, "ABC", 2020, None)]


def test_indicators_without_any_year_are_kept(spark):
    raw = text_frame(spark, ("A", None), ("B", "x"), columns="c t").toDF("_i", "Country Code", "Time")
    assert cleaning.clean_country_indicators(raw, ["_i"]).count() == 2


# ---- registry, marts, reports ----

def test_registry_matches_by_prefix(spark):
    wanted = {"Current_air_quality_data": cleaning.clean_current_air_quality,
              "air_quality_index": cleaning.clean_air_quality_index,
              "historical_weather": cleaning.clean_historical_weather,
              "GlobalEnvironmentalTemperatureTrends": cleaning.clean_environment_trends,
              "GlobalLandTemperaturesByMajorCity": cleaning.clean_city_land_temperature,
              "natural_disaster_database": cleaning.clean_natural_disasters,
              "world_hapiness_scores": cleaning.clean_happiness, "other": None}
    assert {n: registry.plan_for(n) for n in wanted} == wanted
    other = frame(spark, "x int", (1,))
    assert registry.clean_all({"Other": other}) == {"other": other}


def test_weather_mart(spark):
    weather = frame(spark, "CountryISO string, DateTime timestamp, Year int, t int",
                    ("FRA", DAY, 2024, 1), (None, DAY, 2024, 2), ("FRA", datetime(2021, 12, 31), 2021, 3))
    index = frame(spark, "CountryISO string, DateTime timestamp, Year int, aqi int",
                  ("FRA", DAY, 2024, 7), (None, DAY, 2024, 8), ("FRA", datetime(2021, 12, 31), 2021, 9))
    mart = marts.weather_air_index(weather, index)
    assert mart.columns == ["CountryISO", "DateTime", "Year_x", "t", "Year_y", "aqi"]
    assert rows(mart.select("t", "aqi"), "t") == [(1, 7), (2, 8)]
    assert rows(marts.weather_air_index(weather, index, match_nulls=False).select("t")) == [(1,)]


def test_mart_range_reaches_the_scan(spark, tmp_path):
    weather = frame(spark, "CountryISO string, DateTime timestamp", ("FRA", DAY))
    weather.write.parquet(f"{tmp_path}/w")
    stored = spark.read.parquet(f"{tmp_path}/w")
    text = plan(marts.weather_air_index(stored, stored))
    assert text.count("GreaterThanOrEqual(DateTime,2022-01-01") >= 2
    assert text.count("LessThan(DateTime,2026-01-01") >= 2


def test_happiness_mart(spark):
    air = frame(spark, "City string, CountryISO string, Year int", ("Paris", "FRA", 2025),
                ("Nice", "FRA", 2025), ("Rome", "ITA", 2025))
    scores = frame(spark, "country string, CountryISO string, year int", ("France", "FRA", 2024))
    mart = marts.air_quality_happiness(air, scores)
    assert rows(mart, "City") == [("Nice", "FRA", 2025, "France", 2024), ("Paris", "FRA", 2025, "France", 2024)]
    assert mart.columns == ["City", "CountryISO", "Year_x", "country", "year_y"]


def test_city_ranking(spark):
    counters = frame(spark, "city string, positive bigint, negative bigint", ("A", 1, None),
                     ("B", None, 1), ("C", 5, 2), ("D", 1, 0))
    got = reports.city_ranking(counters)
    assert rows(got, "position") == [
        (1, "🥇", "C", 3), (2, "🥈", "A", 1), (3, "🥉", "D", 1), (4, "", "B", -1)]
    only_good = reports.city_ranking(counters.select("city", "positive"))
    assert rows(only_good.select("city"), "position")[0] == ("C",)


def test_explorers(spark):
    df = frame(spark, "n string, a int, b double", ("x", 1, 2.0), ("y", 3, 4.0))
    shape, first = reports.table_explorer(df, 1, ["a"])
    assert rows(shape) == [(2, 3)] and rows(first) == [("x", 1, 2.0)]
    assert reports.numeric_explorer(df).columns == ["x", "y"]
    assert "bin" in reports.numeric_explorer(df.select("a")).columns
    assert reports.numeric_explorer(df.select("n")) is None
    assert reports.numeric_explorer(df, "none") is None


def test_quality_reports(spark):
    raw = text_frame(spark, ("bad", "91", "-1"), ("2024-01-01", None, "x"),
                     columns="date latitude AverageTemperatureUncertainty")
    assert rows(quality.quality_report("Historical_Weather", raw).select("rule", "violations", "rows")) == [
        ("date_unparsed", 1, 2), ("uncertainty_negative", 1, 2), ("latitude_outside_range", 2, 2)]
    trends = text_frame(spark, ("x", "5"), ("2020", None), columns="Year Rainfall_mm")
    assert rows(quality.quality_report("GlobalEnvironmentalX", trends).select("rule", "violations")) == [
        ("Year_not_numeric", 1), ("Rainfall_mm_not_numeric", 1)]
    scores = text_frame(spark, ("11", "1", "0"), columns="a b c").toDF(
        "_i", "Ladder score", "lowerwhisker", "upperwhisker")
    assert rows(quality.quality_report("world", scores).select("violations")) == [(1,), (1,), (1,)]
    assert quality.quality_report("unknown", scores) is None
