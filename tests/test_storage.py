import os
import uuid

import pytest
from pyspark.sql import functions as F

from table_queries import storage
from terravane.operators import ranking
from terravane.plans import flow, ingest, marts
from terravane.sources import landing, messages, payloads, zones
from terravane.sources.landing import EmptyZoneError
from terravane.sources.messages import as_kafka_values, kafka_options, kafka_sink_options
from tests.helpers import frame, plan, rows, text_frame

SF = "/root/testdata/sf0.01"


@pytest.fixture
def zone(spark, tmp_path):
    name = f"z_{uuid.uuid4().hex[:10]}"
    zones.create_zone(spark, name, str(tmp_path / name))
    return name


def csv(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_lands_as_text_in_line_order(spark, tmp_path):
    lines = [f"{i},{1000 - i}" for i in range(500)]
    source = csv(tmp_path / "a.csv", "No. one,Val\n" + "\n".join(lines) + "\n")
    landing.land_csv(spark, source, str(tmp_path / "lake"), "numbers")
    df = landing.read_zone_table(spark, str(tmp_path / "lake"), "numbers")
    assert dict(df.drop("_ordinal").dtypes) == {"No__one": "string", "Val": "string"}
    shuffled = df.repartition(7, "Val")
    assert rows(ranking.head(shuffled, 3)) == [("0", "1000"), ("1", "999"), ("2", "998")]
    assert rows(ranking.tail(shuffled, 2)) == [("499", "501"), ("498", "502")]


def test_several_files_are_one_table(spark, tmp_path):
    paths = [csv(tmp_path / f"{n}.csv", f"x\n{n}\n") for n in "ab"]
    assert rows(landing.read_csv(spark, paths, ordinal=False), "x") == [("a",), ("b",)]


def test_zone_scan_skips_and_reports(spark, tmp_path):
    root = str(tmp_path / "lake")
    with pytest.raises(EmptyZoneError):
        landing.read_zone(spark, root)
    landing.write_table(frame(spark, "x int", (1,)), root, "good")
    (tmp_path / "lake" / "notes").mkdir()
    (tmp_path / "lake" / "broken").mkdir()
    (tmp_path / "lake" / "broken" / "_SUCCESS").write_text("")
    tables, failed = landing.read_zone(spark, root)
    assert list(tables) == ["good"] and list(failed) == ["broken"]


def test_landing_append_and_overwrite(spark, tmp_path):
    root, df = str(tmp_path), frame(spark, "x int", (1,))
    landing.write_table(df, root, "t")
    landing.write_table(df, root, "t", mode="append")
    assert landing.read_zone_table(spark, root, "t").count() == 2
    landing.write_table(df, root, "t")
    assert landing.read_zone_table(spark, root, "t").count() == 1


def test_compaction_merges_files(spark, tmp_path):
    source = landing.write_table(spark.range(1000).repartition(20), str(tmp_path), "many")
    assert landing.compact(spark, source, str(tmp_path / "few")) == 1
    assert len(list((tmp_path / "few").glob("*.parquet"))) == 1
    assert landing.read_zone_table(spark, str(tmp_path), "few").count() == 1000
    with pytest.raises(Exception, match="(?i)exist"):
        landing.compact(spark, source, str(tmp_path / "few"))


def test_compaction_keeps_partitions_and_bounds_files(spark, tmp_path):
    df = spark.range(60_000).select(F.rand(3).alias("x"), F.when(F.col("id") < 55_000, "big").otherwise(
        F.when(F.col("id") < 59_999, "a b=c")).alias("p"), F.lit(1).alias("q"))
    df.repartition(12).write.partitionBy("p", "q").parquet(str(tmp_path / "many"))
    (tmp_path / "many" / "_notes").write_text("no data")
    mb = 0.1
    files = landing.compact(spark, str(tmp_path / "many"), str(tmp_path / "few"), mb)
    back = spark.read.parquet(str(tmp_path / "few"))
    assert rows(back.groupBy("p", "q").count(), "count") == [(None, 1, 1), ("a b=c", 1, 4999), ("big", 1, 55_000)]
    assert back.agg(F.sum("x")).first()[0] == pytest.approx(df.agg(F.sum("x")).first()[0])
    found = list((tmp_path / "few").rglob("*.parquet"))
    assert len(found) == files and max(f.stat().st_size for f in found) < 2 * mb * 2**20
    assert len(list((tmp_path / "few" / "p=big" / "q=1").glob("*.parquet"))) > 3


def test_clear_landing_zone_keeps_other_entries(spark, tmp_path):
    landing.write_table(frame(spark, "x int", (1,)), str(tmp_path), "t")
    (tmp_path / "notes").mkdir()
    assert landing.clear_zone(spark, str(tmp_path)) == ["t"]
    assert (tmp_path / "notes").exists() and not (tmp_path / "t").exists()


def test_catalog_zone(spark, zone):
    with pytest.raises(EmptyZoneError):
        zones.read_tables(spark, zone)
    with pytest.raises(ValueError):
        zones.save_tables({}, zone)
    one, two = frame(spark, "x int, _ordinal int", (1, 9)), frame(spark, "x int", (2,), (3,))
    zones.save_tables({"a": one, "b": two}, zone)
    zones.save_table(two, zone, "a", mode="ignore")
    assert rows(zones.read_tables(spark, zone)["a"]) == [(1,)]
    zones.save_table(two, zone, "a")
    assert rows(zones.zone_shapes(spark, zone), "table") == [("a", 2, 1), ("b", 2, 1)]
    assert set(zones.zone_heads(spark, zone, 1)) == {"a", "b"}
    zones.upsert_table(frame(spark, "x int", (3,), (4,)), zone, "b", ["x"])
    assert rows(zones.read_tables(spark, zone)["b"], "x") == [(2,), (3,), (4,)]
    with pytest.raises(Exception, match="twice"):
        zones.upsert_table(frame(spark, "x int", (5,), (5,)), zone, "b", ["x"])
    zones.save_table(frame(spark, "x int", (7,)), zone, "b__merged")  # as a crash leaves it
    zones.upsert_table(frame(spark, "x int", (None,), (None,)), zone, "b", ["x"])
    assert rows(zones.read_tables(spark, zone)["b"], "x") == [(None,), (None,), (7,)]
    zones.save_table(frame(spark, "x int, p int", (1, 1), (2, 2)), zone, "c", partition_by=["p"])
    zones.upsert_table(frame(spark, "x int, p int", (1, 3)), zone, "c", ["x"])
    assert [c.name for c in spark.catalog.listColumns(f"{zone}.c") if c.isPartition] == ["p"]
    assert rows(zones.read_tables(spark, zone)["c"], "x") == [(1, 3), (2, 2)]
    assert [t for t in zones.reset_zone(spark, zone) if "__" not in t] == ["a", "b", "c"]
    assert zones.table_names(spark, zone) == []


def files_of(spark, zone, name, condition):
    df = zones.read_tables(spark, zone)[name].filter(condition)
    return {r[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_upsert_leaves_other_partitions_alone(spark, zone):
    kind = "x int, v string, p string, q int"
    zones.save_table(frame(spark, kind, (1, "a", "k'1", 1), (2, "a", "k'1", 2), (3, "a", None, 1), (4, "a", "k2", 1),
                           (5, "a", "k2", 1)), zone, "t", partition_by=["p", "q"])
    kept = files_of(spark, zone, "t", "p = \"k'1\" and q = 2")
    changes = frame(spark, kind, (1, "b", "k3", 1), (3, "b", "k2", 1), (4, "b", "k2", 1), (None, "n", None, 9))
    zones.upsert_table(changes, zone, "t", ["x"])
    assert rows(zones.read_tables(spark, zone)["t"].select("x", "v", "p", "q"), "x") == [
        (None, "n", None, 9), (1, "b", "k3", 1), (2, "a", "k'1", 2), (3, "b", "k2", 1), (4, "b", "k2", 1),
        (5, "a", "k2", 1)]
    assert files_of(spark, zone, "t", "p = \"k'1\" and q = 2") == kept and len(kept) == 1
    left = {r.partition for r in spark.sql(f"SHOW PARTITIONS `{zone}`.t").collect()}
    assert len(left) == 4  # those that lost their last row are gone
    zones.upsert_table(changes.limit(0), zone, "t", ["x"])
    assert zones.table_names(spark, zone) == ["t"]
    with pytest.raises(Exception, match="twice"):
        zones.upsert_table(frame(spark, kind, (8, "", "", 1), (8, "", "", 1)), zone, "t", ["x"])


def test_an_interrupted_merge_is_finished_and_not_listed(spark, zone, monkeypatch):
    kind = "x int, p int"
    zones.save_table(frame(spark, kind, (1, 1), (2, 2)), zone, "t", partition_by=["p"])
    with monkeypatch.context() as broken:
        broken.setattr(zones, "_put_in_place", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            zones.upsert_table(frame(spark, kind, (1, 3)), zone, "t", ["x"])
    assert zones.table_names(spark, zone) == ["t"] and set(zones.read_tables(spark, zone)) == {"t"}
    zones.upsert_table(frame(spark, kind, (4, 4)), zone, "t", ["x"])
    assert rows(zones.read_tables(spark, zone)["t"], "x") == [(1, 3), (2, 2), (4, 4)]
    assert zones.reset_zone(spark, zone) == ["t"]
    assert not [t for t in spark.catalog.listTables(zone) if not t.isTemporary]


def test_weather_payloads(spark):
    raw = text_frame(
        spark,
        '{"city": "Madrid", "daily": {"start": "2024-01-01", "end": "2024-01-03", '
        '"temperature_2m_mean": [5.1, null, 6.3]}}',
        '{"city": "Atlantis", "daily": {"start": "2024-01-01", "end": "2024-01-01", '
        '"temperature_2m_mean": [1.0]}}', columns="value")
    bad = [f'{{"city": "{c}", "daily": {{"start": "{a}", "end": "{b}", "temperature_2m_mean": [{v}]}}}}'
           for c, a, b, v in (("Paris", "2024-01-02", "2024-01-01", "1.0"), ("Rome", "x", "2024-01-01", "1.0"),
                              ("Lima", "2024-01-01", "2024-01-01", "1.0, 2.0"))]
    raw = raw.unionByName(text_frame(spark, *bad, "no JSON", columns="value"))
    days, unknown = payloads.daily_weather(raw)
    assert [(str(r.date), r.temperature_2m_mean, r.latitude) for r in days.orderBy("date").collect()] == [
        ("2024-01-01", 5.1, 40.42), ("2024-01-02", None, 40.42), ("2024-01-03", 6.3, 40.42)]
    assert {r.city for r in unknown.collect()} == {"Atlantis", "Paris", "Rome", "Lima", None}


def test_station_payloads(spark):
    raw = text_frame(
        spark,
        ("A", '{"status": "ok", "data": {"aqi": 42, "iaqi": {"pm25": {"v": 10.5}, "no2": {"v": 3.0}}}}'),
        ("B", '{"status": "ok", "data": {"aqi": "-", "iaqi": {}}}'),
        ("C", '{"status": "error", "data": "Unknown station"}'), columns="city value")
    got = payloads.station_readings(raw)
    assert rows(got.drop("date"), "city") == [("A", "42", 10.5, None, 3.0), ("B", "-", None, None, None)]


def test_ingestion_takes_payloads_or_the_whole_backup(spark, tmp_path):
    root = str(tmp_path / "lake")
    good = '{"status": "ok", "data": {"aqi": "-", "iaqi": {"no2": {"v": 3.0}}}}'
    raw = text_frame(spark, ("A", good), ("B", '{"status": "error", "data": "x"}'), ("C", None),
                     columns="city value").drop("_i")
    backup = text_frame(spark, ("Z", "2025-01-02", "7", "n/a", "extra"),
                        columns="city date aqi pm25 other")
    rejected = ingest.land_stations(raw, root, backup)
    assert sorted(r.city for r in rejected.collect()) == ["B", "C"]
    landed = landing.read_zone_table(spark, root, ingest.STATION_TABLE)
    assert rows(landed.drop("date")) == [("A", None, None, None, 3.0)]
    ingest.land_stations(raw.filter("city <> 'A'"), root, backup)
    landed = landing.read_zone_table(spark, root, ingest.STATION_TABLE)
    assert rows(landed.withColumn("date", F.col("date").cast("string"))) == [
        ("Z", "2025-01-02", 7.0, None, None, None)]


def test_kafka_is_a_parameter(spark):
    assert kafka_options("posts", "broker:9092", "g")["startingOffsets"] == "latest"
    assert kafka_sink_options("posts", "broker:9092")["kafka.acks"] == "all"
    assert rows(as_kafka_values(frame(spark, "a int, b string", (1, "é")))) == [('{"a":1,"b":"é"}',)]


def test_whole_flow(spark, tmp_path):
    root = str(tmp_path / "lake")
    files = {
        "Current_air_quality_data": "city,date,aqi,pm25,pm10,no2\nParis,2025-01-01,5,1,1,1\nParis,2025-01-01,6,1,1,1\n",
        "world_hapiness_scores": "Country name,Ladder score\nFrance,7\nKosovo,5\nPeru,\n",
        "historical_weather": "date,temperature_2m_mean,city,latitude,longitude\n2024-01-01,5,Paris,1,2\n2020-01-01,5,Paris,1,2\n",
        "air_quality_index": "Date,Country,AQI Value\n2024-01-01,France,50\n2020-01-01,France,51\n",
        "other": "x\n1\n",
    }
    for name, text in files.items():
        landing.land_csv(spark, csv(tmp_path / f"{name}.csv", text), root, name)
    mark = uuid.uuid4().hex[:8]
    trusted, served = f"trusted_{mark}", f"served_{mark}"
    for name in (trusted, served):
        zones.create_zone(spark, name, str(tmp_path / name))
    built = flow.run_all(spark, root, trusted, served)
    assert built == ["merged_airquality_happiness_2025", "merged_hw_aq_2022_2025"]
    tables = zones.read_tables(spark, served)
    assert set(tables) == {n.lower() for n in files} | set(built)
    assert rows(tables[built[0]].select("City", "aqi", "country", "ladder_score")) == [
        ("Paris", 5.0, "France", 7.0)]
    assert rows(tables[built[1]].select("City", "aqi")) == [("Paris", 50.0)]
    assert all("_ordinal" not in df.columns for df in tables.values())
    audit = {(r.dataset, r.check, r.item): r.n for r in spark.table(f"{trusted}.flow_audit").collect()}
    assert audit["current_air_quality_data", "repeated", None] == 1
    assert audit["world_hapiness_scores", "rows", None] == 3
    assert audit["other", "rows", None] == 1
    assert {k[0] for k in audit} == {n.lower() for n in files}
    for name in ("historical_weather", "air_quality_index"):
        assert [c.name for c in spark.catalog.listColumns(f"{served}.{name}") if c.isPartition] == ["Year"]
    mart = marts.weather_air_index(tables["historical_weather"], tables["air_quality_index"])
    assert plan(mart).count("PartitionFilters: [isnotnull(Year") == 2

    # A second run leaves the marts alone unless asked to refresh them.
    landing.land_csv(spark, csv(tmp_path / "n.csv", "Date,Country,AQI Value\n2024-01-01,France,60\n"),
                     root, "air_quality_index")
    flow.run_all(spark, root, trusted, served)
    assert rows(spark.table(f"{served}.{built[1]}").select("aqi")) == [(50.0,)]
    flow.run_all(spark, root, trusted, served, mart_mode="overwrite")
    assert rows(spark.table(f"{served}.{built[1]}").select("aqi")) == [(60.0,)]


def test_tail_of_parallel_parts(spark, tmp_path):
    """Parts of one write follow by number, whichever task ended first."""
    path = str(tmp_path / "posts")
    for low, high in ((0, 10), (10, 400)):
        spark.range(low, high).selectExpr("cast(id as string) text").repartitionByRange(
            4, F.col("text").cast("int")).sortWithinPartitions(F.col("text").cast("int")).write.mode(
            "append").json(path)
    parts = sorted((tmp_path / "posts").glob("part-*.json"), key=lambda f: f.stat().st_mtime_ns)
    late = {f.name[11:47] for f in parts[-1:]}
    last = sorted(f for f in parts if f.name[11:47] in late)
    for age, file in enumerate(last):  # the last part was done first
        then = parts[-1].stat().st_mtime + 60 - age
        os.utime(file, (then, then))
    lines = messages.read_json_lines(spark, path, messages.POST_SCHEMA, ordinal=True)
    got = [int(r[0]) for r in rows(ranking.tail(lines, 400).select("text"))]
    assert got == list(range(399, -1, -1))


def test_stream_file_tail_lands_every_document(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "tail")
    monkeypatch.setattr(storage, "fresh_path", lambda *_: path)
    storage.registry.queries["stream_file_tail"](spark, SF)
    landed = spark.read.schema("text string").json(path)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert landed.count() == docs.count()
    assert landed.exceptAll(docs.select("text")).isEmpty()
    sizes = {}
    for f in (tmp_path / "tail").glob("part-*.json"):
        sizes[f.name[11:47]] = sizes.get(f.name[11:47], 0) + f.stat().st_size
    assert len(sizes) == 2 and 5 * min(sizes.values()) < max(sizes.values())
