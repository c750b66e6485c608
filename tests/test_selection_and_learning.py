"""Median selection, gazetteer filters, learned labels and distinct values against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.operators import aggregates, learned, medians, text
from tests.helpers import frame, plan, rows, text_frame

INF = float("inf")


# ---- medians ----

@pytest.mark.parametrize("values", [
    [INF], [-INF, INF], [-INF, -INF, 3.0], [1.0, INF, INF, INF], [0.0, -0.0, 1.0], [5e-324, 1e-323, 1.5e-323],
    [1.7e308, -1.7e308, 1.6e308, 1.65e308], [1.0 + k * 2**-52 for k in range(40)], [-2.0, -1.0, 1.0, 2.0],
], ids=str)
def test_medians_at_the_edges(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = medians.spread_medians(df, "v").first()[0]
    wanted = float(np.median(values)) if not math.isinf(sum(map(abs, values))) else None
    middle = sorted(values)[(len(values) - 1) // 2], sorted(values)[len(values) // 2]
    wanted = middle[0] if middle[0] == middle[1] else middle[0] * 0.5 + middle[1] * 0.5
    assert got == wanted or math.isnan(got) and math.isnan(wanted)


def test_medians_of_heavy_tails(spark):
    """Values of every order of magnitude and sign, several columns at once."""
    random = np.random.default_rng(3)
    whole = random.integers(0, 2**64, 20_000, dtype=np.uint64).view(np.float64)
    whole = whole[np.isfinite(whole)][:19_001]
    tail = np.exp(random.normal(0, 80, len(whole)))
    few = random.choice([1.25, 1.5], len(whole))
    data = [tuple(map(float, r)) for r in zip(whole, tail, few)]
    df = spark.createDataFrame(data, "a double, b double, c double").withColumn("d", F.lit(None).cast("double"))
    got = medians.spread_medians(df, "a", "b", "c", "d").first()
    assert tuple(got)[:3] == (np.median(whole), np.median(tail), np.median(few)) and got.d is None


def test_median_passes_count_slices_only(spark):
    values = spark.range(300_000).select(F.lit(0).alias("c"), (F.col("id") * F.col("id")).cast("double").alias("v"))
    counted = medians._counted(values, ["c"], medians._magnitude(F.col("v")))
    assert counted.count() <= 1 << 16
    ordered = counted.orderBy("slice").collect()
    assert all(a.high < b.low for a, b in zip(ordered, ordered[1:]))
    imputed = medians.impute_medians(values, "v")
    assert "Window" not in plan(imputed) and "Exchange" not in plan(imputed)


# ---- gazetteers ----

def runs_of(spark, known, words):
    df = spark.createDataFrame([(words,)], "w array<string>")
    found = df.select(text.possible_names(F.col("w"), known).alias("r")).first().r
    return {" ".join(words[r.at:r.at + r.length]) for r in found}


def test_no_run_grows_beyond_a_dead_beginning(spark):
    names = [["new", "york", "city"], ["lima"], ["a", "b", "c", "d", "e", "f", "g"]]
    known = text.name_filter(spark.createDataFrame([(n,) for n in names], "words array<string>"))
    assert known.longest == 7 and len(known.starts) << 6 == 1 << known.bits
    assert sum(bin(x & 2**64 - 1).count("1") for x in known.starts) == 11  # beginnings of all names
    assert sum(bin(x & 2**64 - 1).count("1") for x in known.wholes) == 3
    words = "in new york a b c d e f lima new york city".split()
    assert runs_of(spark, known, words) == {"lima", "new york city"}


@pytest.mark.parametrize("bits", [7, 23])
def test_gazetteer_equals_brute_force(spark, bits):
    """Also with a filter that is too small to stop anything."""
    random = np.random.default_rng(9)
    letters = list("abcdé")
    names = {" ".join(random.choice(letters, random.integers(1, 6))) for _ in range(150)}
    texts = [" ".join(random.choice([*letters, "X,", "-"], 60)) for _ in range(40)]
    gazetteer = spark.createDataFrame([(n,) for n in names], "place string")
    df = text_frame(spark, *texts, columns="text")
    got = set(rows(text.place_mentions(df, "text", gazetteer, ["_i"], filter_bits=bits)))
    wanted = set()
    for i, t in enumerate(texts):
        joined = f" {' '.join(re.findall(r'[^\W\d_]+', t.lower()))} "
        wanted |= {(i, n) for n in names if f" {n} " in joined}
    assert got == wanted


# ---- learned labels ----

LABELLED = [("good day, good sun", 1), ("a good idea", 1), ("bad bad day", 0), ("awful and bad", 0), ("bad idea", 0),
            ("nobody knows", None), (None, 1), ("", 0), ("x" * 65 + " good", 1)]


def brute_weights(data):
    known = [(set(re.findall(r"[^\W\d_]+", (t or "").lower())), y) for t, y in data if y is not None]
    goods, bads = sum(y for _, y in known), sum(1 - y for _, y in known)
    counts = Counter((w, y) for ws, y in known for w in ws)
    words = {w for w, _ in counts if len(w) <= 64}
    return {w: round(math.log((counts[w, 1] + 1) / (goods + 2) / ((counts[w, 0] + 1) / (bads + 2))) * 1e6)
            for w in words}


def test_word_weights(spark):
    df = spark.createDataFrame(LABELLED, "t string, y int")
    got = {r.word: r.weight for r in learned.word_weights(df, "t", "y").collect()}
    assert got == brute_weights(LABELLED)
    most = learned.word_weights(df, "t", "y", max_words=2).collect()
    assert {r.word for r in most} == {"good", "bad"}
    assert learned.word_weights(df.filter("y = 1"), "t", "y").count() == 0
    assert learned.word_weights(df.limit(0), "t", "y").count() == 0


def test_learned_labels(spark):
    df = spark.createDataFrame(LABELLED, "t string, y int")
    weights = brute_weights(LABELLED)
    classify = learned.learned_label(df, "t", "y")
    texts = ["Good good, unheard", "bad", "unheard of", None, "good bad", "an idea"]
    got = text_frame(spark, *texts).select("_i", classify("t").alias("l")).orderBy("_i").collect()
    for r, t in zip(got, texts):
        known = [weights[w] for w in set(re.findall(r"\w+", (t or "").lower())) if w in weights]
        mean = sum(known) / len(known) if known else None
        label = "neutral" if not mean else "good" if mean > 0 else "bad"
        assert r.l.label == label
        assert r.l.score == pytest.approx(1 if mean is None else 1 / (1 + math.exp(-abs(mean) / 1e6)))
    empty = learned.WordModel(learned.word_weights(df.limit(0), "t", "y"))
    assert rows(df.select(empty.label("t").alias("l")).select("l.*").distinct()) == [("neutral", 1.0)]


def test_learned_labels_stay_in_the_row(spark):
    """No join, shuffle or Python; the classifier fits into the enrichment of posts."""
    df = spark.createDataFrame(LABELLED, "t string, y int")
    classify = learned.learned_label(df, "t", "y")
    scored = plan(df.select(classify("t")))
    assert not re.search("Join|Exchange|EvalPython", scored)
    posts = text_frame(spark, ("t0", "a good day in Lima"), ("t1", "bad Paris"), columns="created_at text")
    got = rows(text.enrich_posts(posts, classifier=classify).select("city", "assessment"), "city")
    assert got == [("Lima", "good"), ("Paris", "bad")]


def test_separation(spark):
    random = np.random.default_rng(1)
    data = [(float(round(random.normal(y, 1), 2)), int(y)) for y in random.integers(0, 2, 300)]
    df = spark.createDataFrame([*data, (0.5, None), (None, 0)], "s double, y int")
    ones = [s for s, y in data if y]
    zeros = [s for s, y in data if not y] + [-INF]  # a missing score is the lowest
    area = np.mean([[0.5 * (a == b) + (a > b) for b in zeros] for a in ones])
    got = learned.separation(df, "s", "y", steps=100).first()
    assert (got.texts, got.goods) == (301, len(ones)) and got.area == pytest.approx(area)
    assert learned.separation(df.filter("y = 1"), "s", "y").first().area is None
    assert tuple(learned.separation(df.limit(0), "s", "y").first()) == (0, 0, None)


# ---- distinct values ----

def test_distinct_ratios_take_one_shuffle(spark):
    df = spark.createDataFrame(
        [(1, "a", [1], 1.5), (1, None, [1], None), (2, "a" * 99, None, 1.5), (3, "a" * 99, [], -0.5)],
        "i int, t string, l array<int>, d double")
    ratios = aggregates.distinct_ratios(df, "i", "t", "l", "d")
    assert rows(ratios) == [(0.75, 0.5, 0.5, 0.5)]
    assert not re.search(r"\bExpand\b", plan(ratios))
    assert len(set(re.findall(r"hashpartitioning\(c#\d+, digest#\d+", plan(ratios)))) == 1
    assert rows(aggregates.distinct_ratios(df.limit(0), "i", "t")) == [(None, None)]


def test_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 7).alias("day"), (F.col("id") % 9000).cast("string").alias("t"),
                                    F.lit(None).cast("string").alias("none"))
    sketches = aggregates.distinct_sketches(df, ["day"], "t", "none")
    assert sketches.count() == 14
    found = {r.column: r for r in aggregates.sketched_ratios(sketches).collect()}
    assert found["t"].rows == 40_000 and found["t"]["values"] == pytest.approx(9000, rel=0.03)
    assert found["none"]["values"] == 0
    part = aggregates.sketched_ratios(sketches.filter("day < 3")).filter("column = 't'").first()
    exact = df.filter("day < 3").select("t").distinct().count()
    assert part["values"] == pytest.approx(exact, rel=0.03)
