"""Random frames through Spark operators and the pandas calls with the same meaning."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terravane.functions import numbers, strings
from terravane.operators import dedup, filters, joins, medians
from tests.helpers import rows, text_frame


def clean(value):
    return None if pd.isna(value) else value


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(11)
    letters = list("0123456789+-.eE infaINFtyx_d, \t")
    made = ["".join(rng.choice(letters, size=rng.integers(0, 7))) for _ in range(5000)]
    return made + ["Infinity", "-inf", "1e308", "1e309", "1e-400", "0x10", "NaN", "True", "\xa04"]


def test_lenient_numbers(spark, texts):
    got = text_frame(spark, *texts).select("_i", numbers.num("t")).orderBy("_i").collect()
    wanted = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    differing = [(t, g[1], w) for t, g, w in zip(texts, got, wanted) if g[1] != clean(w)]
    assert differing == []


def test_strip_lower_title(spark, texts):
    words = [t + w for t, w in zip(texts, ["o'neil-smith", "éa b2c", "\x1cx\x85", "ALL CAPS"] * 500)]
    df = text_frame(spark, *words).select(
        "_i", strings.strip("t"), strings.strip_lower("t"), strings.title_case("t"))
    for row, word in zip(df.orderBy("_i").collect(), words):
        assert tuple(row)[1:] == (word.strip(), word.strip().lower(), word.title())


@pytest.fixture(scope="module")
def pair(spark):
    """The same random table in pandas and in Spark; keys hold many missing values."""
    rng = np.random.default_rng(5)
    n = 3000
    pdf = pd.DataFrame({
        "o": range(n),
        "k": rng.choice(["a", "b", "c", None], n, p=[0.4, 0.2, 0.1, 0.3]),
        "d": rng.choice([1.0, 2.0, 3.0, None], n).astype(float),
        "v": np.where(rng.random(n) < 0.2, np.nan, rng.normal(scale=50, size=n)),
    })
    data = [tuple(clean(x) for x in r) for r in pdf.itertuples(index=False)]
    return pdf, spark.createDataFrame(data, "o int, k string, d double, v double").repartition(6)


def test_keep_first(pair):
    pdf, df = pair
    for keys in (["k"], ["k", "d"], ["v"]):
        kept = dedup.keep_first(df, keys, ["o"])
        wanted = pdf.drop_duplicates(subset=keys, keep="first")["o"].tolist()
        assert [r[0] for r in rows(kept.select("o"), "o")] == wanted


def test_inner_join_with_missing_keys(pair):
    pdf, df = pair
    small = pdf.iloc[::50][["k", "d", "v"]]
    other = df.filter(F.col("o") % 50 == 0).select("k", "d", "v")
    wanted = pd.merge(pdf, small, on=["k", "d"], how="inner")
    joined = joins.inner_join(df, other, ["k", "d"], match_nulls=True)
    assert set(joined.columns) == set(wanted.columns)
    got = sorted(rows(joined.select("o", F.coalesce("v_y", F.lit(-1e9)))))
    assert got == sorted(zip(wanted["o"], wanted["v_y"].fillna(-1e9)))


def test_median_fill(pair):
    pdf, df = pair
    wanted = pdf["v"].fillna(pdf["v"].median())
    got = [r[1] for r in rows(medians.impute_medians(df, "v").select("o", "v"), "o")]
    assert got == pytest.approx(wanted.tolist(), rel=1e-15)


def test_range_rules(pair):
    pdf, df = pair
    kept = pdf[pdf["v"].notna() & (pdf["v"] >= 0)]["o"].tolist()
    assert [r[0] for r in rows(filters.keep_non_negative(df, "v").select("o"), "o")] == kept
    inside = pdf["v"].where(pdf["v"].between(-90, 90))
    got = rows(df.select("o", numbers.null_outside("v", (-90, 90))), "o")
    assert [g[1] for g in got] == [clean(x) for x in inside]
    named = pdf[pdf["k"].str.strip().str.lower() != "a"]["o"].tolist()
    loose = filters.exclude_entity(df, "k", "a", strings.strip_lower)
    assert [r[0] for r in rows(loose.select("o"), "o")] == named
