import re
import statistics
from pathlib import Path

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from table_queries import QUERIES
from terravane import dimensions, staging
from terravane.operators import (
    aggregates,
    columns,
    dedup,
    joins,
    medians,
    ranking,
    tables,
    text,
)
from tests.helpers import frame, plan, rows, text_frame

SLOW = settings(max_examples=6, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---- de-duplication ----

def test_keep_first_with_missing_keys(spark):
    df = frame(spark, "k string, v int, o int", ("a", 1, 2), ("a", 2, 1), (None, 3, 3),
               (None, 4, 4))
    kept = dedup.keep_first(df, ["k"], ["o"])
    assert rows(kept.select("k", "v"), "v") == [("a", 2), (None, 3)]
    assert rows(dedup.keep_first(kept, ["k"], ["o"]), "v") == rows(kept, "v")


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text_plan = plan(dedup.keep_first(df, ["k"], ["id"]))
    assert text_plan.index("WindowGroupLimit") < text_plan.index("Exchange")
    assert "Partial" in text_plan


def test_distinct_rows_ignore_the_ordinal(spark):
    df = frame(spark, "a string, _ordinal int", ("x", 3), ("x", 1), (None, 2), (None, 5))
    assert rows(dedup.distinct_rows(df), "a") == [(None,), ("x",)]
    assert rows(dedup.dedup_audit(df)) == [(4, 2)]


# ---- lookups and joins ----

def test_country_codes(spark):
    df = text_frame(spark, "south korea", "UK", "Kosovo", "Atlantis", " côte d'ivoire ", None,
                    "TAIWAN", "Taiwan Province of China", "Isle of Man", "Syria")
    got = joins.add_country_code(df, "t").orderBy("_i")
    assert [r.CountryISO for r in got.collect()] == [
        "KOR", "GBR", None, None, "CIV", None, None, "TWN", "IMN", None]


def test_iso_register_is_complete(spark):
    register = dimensions.iso_register(spark)
    assert register.count() == register.select("alpha3").distinct().count() == 249
    known = {r.name: r.alpha3 for r in register.collect()}
    assert known["Türkiye"] == "TUR" and known["Germany"] == "DEU" and "Turkey" not in known


def test_own_register_and_corrections(spark):
    register = frame(spark, "name string, alpha3 string", ("Gondor, Realm of", "GON"))
    fixes = frame(spark, "name string, corrected string", ("Gondor", "Gondor, realm of"),
                  ("Mordor", None))
    df = text_frame(spark, "GONDOR", "mordor", "France")
    got = joins.add_country_code(df, "t", corrections=fixes, register=register).orderBy("_i")
    assert [r.CountryISO for r in got.collect()] == ["GON", None, None]


def test_city_dimension(spark):
    assert dimensions.cities(spark).count() == 57
    assert dimensions.city_codes(spark).select("iso3").distinct().count() == 44
    found, unknown = joins.add_coordinates(text_frame(spark, "Paris", "Atlantis"), "t")
    assert rows(found.select("t", "latitude", "longitude")) == [("Paris", 48.85, 2.35)]
    assert rows(unknown.select("t")) == [("Atlantis",)]
    as_json = text_frame(spark, '{"Oslo": {"latitude": 59.91, "longitude": 10.75}, "X": {}}',
                         columns="value")
    assert rows(dimensions.cities_from_json(as_json), "city") == [
        ("Oslo", 59.91, 10.75), ("X", None, None)]


def test_null_keys_pair_only_on_request(spark):
    left = frame(spark, "k string, a int", ("A", 1), (None, 2), (None, 3))
    right = frame(spark, "k string, b int", ("A", 1), (None, 2))
    assert joins.inner_join(left, right, ["k"], match_nulls=True).count() == 3
    assert joins.inner_join(left, right, ["k"]).count() == 1
    assert rows(joins.null_key_count(left, ["k"])) == [(2,)]


def test_clashing_columns_get_suffixes(spark):
    left = frame(spark, "k int, Year int, x int", (1, 2, 3))
    right = frame(spark, "Year int, k int, YEAR2 int, X int", (5, 1, 6, 7))
    assert joins.inner_join(left, right, ["k"]).columns == [
        "k", "Year_x", "x_x", "Year_y", "YEAR2", "X_y"]


@pytest.mark.parametrize("match_nulls", [True, False])
def test_salted_join_equals_plain_join(spark, match_nulls):
    left = spark.range(300).select(
        F.when(F.col("id") < 100, None).when(F.col("id") < 200, 7).otherwise(F.col("id") % 10)
        .alias("k"), F.col("id").alias("a"))
    right = spark.range(40).select(
        F.when(F.col("id") % 9 != 0, F.col("id") % 10).alias("k"), F.col("id").alias("b"))
    plain = joins.inner_join(left, right, ["k"], match_nulls)
    salted = joins.inner_join(left, right, ["k"], match_nulls, hot_share=0.2, salts=8)
    assert rows(salted, "a", "b") == rows(plain, "a", "b")
    nulls = joins.inner_join(left, right, ["k"], match_nulls, null_salts=4)
    assert rows(nulls, "a", "b") == rows(plain, "a", "b")


@pytest.mark.parametrize("match_nulls", [True, False])
@pytest.mark.parametrize("parts", [1, 4])
def test_join_in_blocks_equals_plain_join(spark, match_nulls, parts):
    """With keys of two kinds, missing and repeated ones, equal rows and clashing columns."""
    left = spark.range(400).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 5).cast("int").alias("k"),
        F.when(F.col("id") % 11 != 0, F.col("id") % 3).alias("part"), (F.col("id") % 50).alias("a"), F.lit("l").alias("X"))
    right = spark.range(90).select(
        F.when(F.col("id") % 8 != 0, F.col("id") % 6).alias("k"),
        F.when(F.col("id") % 9 != 0, F.col("id") % 4).alias("part"), (F.col("id") % 20).alias("b"), F.lit("r").alias("x"))
    for keys in (["k"], ["part", "k"]):
        plain = joins.inner_join(left, right, keys, match_nulls)
        for block in (3, 1000):
            blocks = joins.inner_join(left, right, keys, match_nulls, block=block, parts=parts)
            assert blocks.columns == plain.columns and blocks.dtypes == plain.dtypes
            assert sorted(map(str, blocks.collect())) == sorted(map(str, plain.collect()))
        assert joins.inner_join(left.limit(0), right, keys, match_nulls, block=3, parts=parts).count() == 0


def sides(spark, folder, customers, suppliers, nations):
    """Tables of one file each, whose rows share few nations."""
    spark.range(customers).select(
        F.col("id").alias("c_custkey"), (F.col("id") % nations).cast("int").alias("c_nationkey"),
        (F.col("id") * 0.5).alias("c_acctbal")).coalesce(1).write.parquet(f"{folder}/customer.parquet")
    spark.range(suppliers).select(
        F.col("id").alias("s_suppkey"), (F.col("id") % nations).cast("int").alias("s_nationkey"),
        (F.col("id") * 0.25).alias("s_acctbal")).coalesce(1).write.parquet(f"{folder}/supplier.parquet")
    return str(folder)


def test_pairs_of_few_keys_are_dealt_to_all_tasks(spark, tmp_path):
    """Small tables with many pairs: neither their bytes nor their files say how many tasks they need."""
    got = QUERIES["join_null_safe"](spark, sides(spark, tmp_path, 2000, 300, 4))
    parts = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(parts) == 4 * 500 * 75
    assert len(parts) == 8 and max(parts) < sum(parts) / 3


def written(spark, monkeypatch, name, folder):
    """(rows, bytes) of a query's result as files, and those of its join without blocks."""
    def size(to):
        QUERIES[name](spark, folder).write.parquet(to)
        return spark.read.parquet(to).count(), sum(p.stat().st_size for p in Path(to).glob("*.parquet"))

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # both sides shuffle, as large ones do
    try:
        blocks, join = size(f"{folder}/blocks"), joins.inner_join
        monkeypatch.setattr(joins, "inner_join", lambda *a, block=0, parts=1, **k: join(*a, **k))
        return blocks, size(f"{folder}/plain")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pairs_of_few_keys_take_little_disk(spark, tmp_path, monkeypatch):
    folder = sides(spark, tmp_path, 320, 20_000, 1)
    (n, blocks), (m, plain) = written(spark, monkeypatch, "join_nulls_apart", folder)
    assert n == m == 320 * 20_000
    assert blocks < plain / 3


def test_marts_pairs_take_little_disk(spark, tmp_path, monkeypatch):
    """One nation and day, with 100 orders and 20,000 shipments."""
    day, folder = F.expr("timestamp_ntz'1997-03-01'"), sides(spark, tmp_path, 50, 20_000, 1)
    spark.range(100).select(F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"),
                            day.alias("o_orderdate")).coalesce(1).write.parquet(f"{folder}/orders.parquet")
    spark.range(20_000).select((F.col("id") * 7 % 20_011).alias("l_partkey"), F.col("id").alias("l_suppkey"),
                              day.alias("l_shipdate")).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    (n, blocks), (m, plain) = written(spark, monkeypatch, "mart_two_key", folder)
    assert n == m == 100 * 20_000
    assert blocks < plain / 3


def test_equal_rows_of_a_table_get_different_salts(spark, tmp_path):
    """By their place in the file, where the frame still shows it; the join gives the same pairs."""
    equal = spark.range(400).select(F.lit(None).cast("string").alias("k"), F.lit(1).alias("x"))
    equal.coalesce(2).write.parquet(str(tmp_path / "equal"))
    stored = spark.read.parquet(str(tmp_path / "equal")).filter("x = 1").withColumnRenamed("x", "y")
    left, _ = joins._nulls_salted(stored, stored.withColumnRenamed("k", "_right_k"), ["k"], 8)
    parts = [r["count"] for r in left.groupBy("_part").count().collect()]
    assert len(parts) == 8 and max(parts) < 100
    assert left.select("_part").collect() == left.select("_part").collect()
    derived = equal.withColumn("_ordinal", F.struct(F.monotonically_increasing_id().alias("row")))
    assert derived.select(joins._row_salt(derived, 8)).distinct().count() == 8
    assert equal.select(joins._row_salt(equal, 8)).distinct().count() == 1
    small = spark.createDataFrame([(None, "a"), (None, "b"), ("k", "c")], "k string, z string")
    for options in ({"null_salts": 8}, {"hot_share": 0.3, "salts": 4}):
        joined = joins.inner_join(stored, small, ["k"], True, **options)
        assert rows(joined.groupBy("z").count(), "z") == [("a", 400), ("b", 400)]


def test_scratch_is_dropped_when_asked(spark):
    path = staging.fresh_path(spark, "scratch")
    spark.range(3).write.parquet(path)
    staging.fresh_path(spark, "never-written")
    dropped = staging.drop_scratch(spark)
    assert any(path.endswith(p.rsplit("/", 1)[-1]) for p in dropped)
    assert not any("never-written" in p for p in dropped) and staging.drop_scratch(spark) == []
    with pytest.raises(Exception, match="(?i)not.exist|not_found"):
        spark.read.parquet(path)


# ---- medians ----

@SLOW
@given(st.lists(st.one_of(
    st.none(), st.integers(-3, 3).map(float),
    st.floats(min_value=-1e12, max_value=1e12, allow_nan=False)), min_size=1, max_size=60))
def test_spread_medians_equal_statistics(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    present = [v for v in values if v is not None]
    expected = statistics.median(present) if present else None
    got = medians.spread_medians(df, "v").collect()[0][0]
    assert got == (None if expected is None else pytest.approx(expected, rel=1e-12, abs=1e-9))


@pytest.mark.parametrize("shape", ["ties", "outlier", "lognormal", "two_values"])
def test_spread_medians_on_awkward_columns(spark, shape):
    rng = np.random.default_rng(7)
    values = {
        "ties": np.repeat([1.0, 2.0, 3.0], [5000, 9001, 6000]),
        "outlier": np.append(rng.normal(size=20000), [1e300, float("inf")]),
        "lognormal": rng.lognormal(sigma=6, size=30001),
        "two_values": np.repeat([0.0, 1.0], [10000, 10000]),
    }[shape]
    df = spark.createDataFrame([(float(v),) for v in rng.permutation(values)], "v double")
    assert medians.spread_medians(df, "v").collect()[0][0] == np.median(values)


def test_imputation(spark):
    df = frame(spark, "i int, a double, b double", (0, 1.0, None), (1, 2.0, None), (2, 3.0, None),
               (3, 10.0, None), (4, None, None), (5, float("nan"), None))
    df = columns.to_numbers(df, "a", "b")
    got = rows(medians.impute_medians(df, "a", "b").select("a", "b", "i"), "i")
    assert [g[0] for g in got] == [1.0, 2.0, 3.0, 10.0, 2.5, 2.5]
    assert {g[1] for g in got} == {None}
    close = rows(medians.impute_medians(df, "a", exact=False).select("a", "i"), "i")
    assert close[4][0] in (2.0, 3.0)


def test_small_and_spread_medians_agree(spark):
    df = spark.range(10001).select(F.sqrt("id").alias("v"))
    assert medians.exact_medians(df, "v").collect() == medians.spread_medians(df, "v").collect()


# ---- aggregates ----

def test_histogram_edges(spark):
    df = frame(spark, "x double", (0.0,), (9.99,), (10.0,), (300.0,), (None,), (float("nan"),))
    assert rows(aggregates.histogram(df, "x").select("bin", "n"), "bin") == [
        (0, 2), (1, 1), (29, 1)]
    same = frame(spark, "x double", (5.0,), (5.0,))
    assert rows(aggregates.histogram(same, "x").select("bin", "n")) == [(0, 2)]


def test_label_counts_and_fallback(spark):
    df = frame(spark, "city string, label string", ("A", "good"), ("A", "good for city"),
               ("A", "bad"), ("B", "neutral"), ("B", None))
    assert rows(aggregates.label_counts(df, "city", "label"), "city") == [
        ("A", 1, 1, 1), ("B", 0, 0, 2)]


def test_profiles(spark):
    df = frame(spark, "a string, b double", ("x", 1.0), ("x", None), ("y", 2.5), (None, None))
    assert rows(aggregates.null_profile(df), "column") == [
        ("a", 4, 1, True, False), ("b", 4, 2, True, False)]
    assert rows(aggregates.distinct_ratios(df)) == [(0.5,)]
    assert rows(aggregates.integrality(df)) == [(False,)]
    assert rows(aggregates.table_shape(df)) == [(4, 2)]
    assert rows(aggregates.null_ratio_above(df, 0.3).select("column")) == [("b",)]


def test_distinct_ratio_of_long_texts(spark):
    df = text_frame(spark, "a" * 100, "a" * 100, "a" * 101, "a").select("t")
    assert rows(aggregates.distinct_ratios(df)) == [(0.75,)]


def test_rule_report_counts_in_one_pass(spark):
    df = frame(spark, "s double", (11.0,), (-1.0,), (5.0,), (None,))
    report = aggregates.rule_report(df, {"range": ~F.col("s").between(0, 10)}, "d")
    assert rows(report) == [("d", "range", 2, 4)]
    fresh = aggregates.rule_report(df, {"low": F.col("s") < 0, "high": F.col("s") > 10})
    assert len(re.findall(r"\+- Exchange", plan(fresh))) == 1


def test_unmatched_values(spark):
    df = frame(spark, "v string, r string", ("b", None), ("a", None), ("a", None), ("c", "x"))
    assert rows(aggregates.unmatched_values(df, "v", "r", limit=1)) == [("a",)]
    assert rows(aggregates.unmatched_values(df, "v", "r"), "v") == [("a",), ("b",)]


def test_observed_counts_ride_on_the_write(spark):
    df, seen = aggregates.observed(spark.range(7).toDF("id"), "seen_rows")
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7}


# ---- ranking ----

def test_ranking_numbers_whole_table(spark):
    df = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("s"))
    order = [F.desc("s"), F.col("id")]
    numbered = rows(ranking.number_rows(df, order).select("position", "id"), "position")
    assert numbered == list(enumerate(sorted(range(5000), key=lambda i: (-(i % 3), i)), start=1))


def test_net_score_treats_missing_as_zero(spark):
    df = frame(spark, "positive bigint, negative bigint", (3, None), (None, None), (1, 3))
    scores = rows(df.select(ranking.net_score().alias("s")))
    assert scores == [(3,), (0,), (-2,)]


def test_top_rows_are_not_sorted_globally(spark):
    df = spark.range(100).toDF("id")
    with pytest.raises(ValueError):
        ranking.tail(df, 3)
    for top in (ranking.head(df, 3, ["id"]), ranking.tail(df, 3, ["id"]),
                ranking.latest(df, "id", 3)):
        assert "TakeOrderedAndProject" in plan(top)
    assert rows(ranking.tail(df, 3, ["id"])) == [(99,), (98,), (97,)]


# ---- whole tables ----

def test_union_fills_missing_columns(spark):
    a, b = frame(spark, "x int", (1,)), frame(spark, "y int, x int", (5, 2))
    assert rows(tables.union_all(a, b), "x") == [(1, None), (2, 5)]


def test_primary_or_backup(spark):
    primary, backup = frame(spark, "x int", (1,)), frame(spark, "x int", (7,), (8,))
    assert rows(tables.primary_or_backup(primary, backup)) == [(1,)]
    assert rows(tables.primary_or_backup(primary.filter("x > 5"), backup), "x") == [(7,), (8,)]
    assert rows(tables.primary_or_backup(None, backup), "x") == [(7,), (8,)]


def test_upsert(spark):
    old = frame(spark, "id int, v string", (1, "a"), (2, "b"), (None, "n"))
    new = frame(spark, "id int, v string", (2, "B"), (3, "C"), (None, "N"))
    assert sorted(rows(tables.upsert(old, new, ["id"])), key=str) == sorted(
        [(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=str)


def test_coordinate_pair(spark):
    df = frame(spark, "name string, a int, b double", ("x", 1, 2.0))
    assert rows(columns.coordinate_pair(df)) == [(1, 2.0)]
    assert rows(columns.coordinate_pair(df, x="b", y="a")) == [(2.0, 1)]
    with pytest.raises(ValueError):
        columns.coordinate_pair(df.select("name", "a"))


def test_end_before_start_is_repaired(spark):
    df = frame(spark, "s int, e int", (5, 1), (1, 5), (1, None), (None, 1))
    assert rows(df.select(columns.repair_end(F.col("s"), F.col("e")))) == [
        (5,), (5,), (None,), (1,)]


# ---- places and labels ----

def cities_in(spark, *texts, **options):
    df = text_frame(spark, *texts, columns="text")
    found = text.detect_places(df, **options)
    return sorted((r._i, r.city) for r in found.collect())


def test_places_are_whole_words_in_any_case(spark):
    assert cities_in(spark, "me gusta barcelona i Madrid", "temperature 19", "Parish in LIMA",
                     "paris, PARIS and Paris", None, "rio-de-JANEIRO; washington d.c.",
                     "brasília") == [
        (0, "Barcelona"), (0, "Madrid"), (2, "Lima"), (3, "Paris"), (5, "Rio de Janeiro"),
        (5, "Washington D.C."), (6, "Brasília")]


def test_overlapping_place_names_are_all_found(spark):
    names = ["York", "New York", "New York City"]
    assert cities_in(spark, "new york city", "old York", places=names) == [
        (0, "New York"), (0, "New York City"), (0, "York"), (1, "York")]


def test_gazetteer_join_equals_list(spark):
    texts = ["Cape Town or Cairo", "from new york to mexico city, new york", "rome"]
    df = text_frame(spark, *texts, columns="text")
    joined = text.place_mentions(df, "text", dimensions.cities(spark), ["_i"], name="city")
    assert sorted(rows(joined)) == cities_in(spark, *texts)


def test_gazetteer_names_of_any_length(spark):
    names = frame(spark, "place string", ("Bosnia and Herzegovina North",), ("Lima",), ("!",), (None,))
    df = text_frame(spark, "to bosnia AND Herzegovina, north", "lima lima", "", None, "Herzegovina North")
    found = text.place_mentions(df.withColumnRenamed("t", "text"), "text", names, ["_i"])
    assert sorted(rows(found)) == [(0, "Bosnia and Herzegovina North"), (1, "Lima")]
    assert text.place_mentions(df.withColumnRenamed("t", "text"), "text", names.limit(0), ["_i"]).count() == 0


def test_first_row_without_an_order_is_the_smallest(spark):
    df = frame(spark, "`a.b` int, x int, m map<string,int>", (1, 5, {}), (1, 3, {}), (2, 9, None))
    for parts in (1, 3):
        spread, order = dedup.with_row_order(df.repartition(parts), None)
        assert rows(dedup.keep_first(spread, [F.col("`a.b`")], order).select("x"), "x") == [(3,), (9,)]


def test_word_labels(spark):
    df = text_frame(spark, "good, great and BAD", "awful", "nothing", "good bad", columns="text")
    got = df.select("_i", text.word_label("text").alias("l")).select("_i", "l.*")
    assert [(r.label, round(r.score, 3)) for r in got.orderBy("_i").collect()] == [
        ("good", 0.667), ("bad", 1.0), ("neutral", 1.0), ("neutral", 0.5)]


def test_enrichment_takes_model_functions(spark):
    import pandas as pd

    @F.pandas_udf("array<string>")
    def tagger(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [w for w in t.split() if w.istitle()])

    @F.pandas_udf("label string, score double")
    def classifier(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"label": ["bad"] * len(texts), "score": [0.25] * len(texts)})

    posts = text_frame(spark, ("t0", "we like Foo Foo Bar"), ("t1", "nothing"),
                       columns="created_at text")
    got = text.enrich_posts(posts, tagger, classifier)
    assert rows(got.select("created_at", "city", "assessment", "score"), "city") == [
        ("t0", "Bar", "bad", 0.25), ("t0", "Foo", "bad", 0.25)]


def test_text_is_searched_once(spark):
    """No filter on the detected places is pushed below their detection."""
    posts = text_frame(spark, "Paris", columns="text").withColumn("created_at", F.lit("t"))
    enriched = plan(text.enrich_posts(posts))
    assert enriched.count("rio(?:") + enriched.count("r(?:ome") == 1
    assert enriched.count("wonderful") == enriched.count("worst") == 1
