"""A label learned from labelled texts: naive Bayes on words, in DataFrame functions only.

The weight of a word is the logarithm of how much more often good texts hold it than bad ones,
with one text of each kind added for every word. A text is judged by the mean weight of its known
words, each counted once, so long texts are not surer than short ones. Weights are whole
millionths: their sums don't depend on the order of rows, and another engine finds the same.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terravane.functions.numbers import let
from terravane.functions.strings import _col

#: Words of a model, at most: those that the most labelled texts hold, ties by the word.
MAX_WORDS = 1 << 16
#: Longer runs of letters are no words of a model, so its size in bytes is bounded as well.
MAX_LETTERS = 64
MICRO = 1_000_000
_BUCKETS = 1 << 12


def text_words(text: Column | str) -> Column:
    """The different lower-cased runs of letters of a text; none for a missing text."""
    words = F.array_remove(F.split(F.lower(_col(text)), r"[^\p{L}]+"), "")
    return F.coalesce(F.array_distinct(words), F.array().cast("array<string>"))


def word_weights(df: DataFrame, text: str, label: str, max_words: int = MAX_WORDS) -> DataFrame:
    """word, texts, weight -- learned from the rows whose ``label`` is 1 (good) or 0 (bad).

    Rows without a label are left out. ``weight`` is in millionths, above zero for words of good
    texts. A class without a row gives no weights, as nothing can be told from it.
    """
    known = df.filter(F.col(label).isNotNull()).select(
        text_words(text).alias("words"), (F.col(label) > 0).cast("int").alias("good"))
    sizes = known.agg(F.sum("good").alias("goods"), F.count(F.lit(1)).alias("all"))
    sizes = sizes.select("goods", (F.col("all") - F.col("goods")).alias("bads"))
    held = (known.select(F.explode("words").alias("word"), "good")
            .filter(F.length("word") <= MAX_LETTERS)
            .groupBy("word").agg(F.sum("good").alias("in_good"), F.count(F.lit(1)).alias("texts"))
            .orderBy(F.desc("texts"), "word").limit(max_words))
    total = sizes.select(F.struct("goods", "bads").alias("s")).scalar()
    goods, bads = total.getField("goods"), total.getField("bads")
    odds = ((F.col("in_good") + 1) / (goods + 2)) / ((F.col("texts") - F.col("in_good") + 1) / (bads + 2))
    return held.filter((goods > 0) & (bads > 0)).select(
        "word", "texts", F.round(F.log(odds) * MICRO).cast("bigint").alias("weight"))


class WordModel:
    """Learned weights as a column function for texts.

    The weights, at most ``MAX_WORDS`` rows of at most ``MAX_LETTERS`` letters, are collected once
    and become a constant of the plan: a hash table of buckets, so a word costs one look-up and
    no row leaves its task. Thus it serves streams like tables.
    """

    def __init__(self, weights: DataFrame):
        rows = (weights.orderBy(F.desc("texts"), "word").limit(MAX_WORDS)
                .select("word", "weight", F.pmod(F.xxhash64("word"), F.lit(_BUCKETS)).alias("bucket")).collect())
        buckets: list[list[dict]] = [[] for _ in range(_BUCKETS)]
        for r in rows:
            buckets[r["bucket"]].append({"word": r["word"], "weight": r["weight"]})
        self.words = len(rows)
        self._table = json.dumps(buckets, ensure_ascii=False)

    def _weight(self, word: Column) -> Column:
        # of a constant text only, so the optimizer turns it into the parsed table
        table = F.from_json(F.lit(self._table), "array<array<struct<word:string,weight:bigint>>>")
        bucket = F.get(table, F.pmod(F.xxhash64(word), F.lit(_BUCKETS)).cast("int"))
        return F.get(F.filter(bucket, lambda e: e["word"] == word), 0)["weight"]

    def mean_weight(self, text: Column | str) -> Column:
        """Mean weight of the known words in millionths; NULL if there is none."""
        weights = F.filter(F.transform(text_words(text), self._weight), lambda w: w.isNotNull())
        return let(weights, lambda ws: F.when(F.size(ws) > 0, F.aggregate(
            ws, F.lit(0).cast("bigint"), lambda s, w: s + w) / F.size(ws)))

    def label(self, text: Column | str, margin: float = 0.0) -> Column:
        """struct<label, score> like ``text.word_label``, for ``enrich_posts`` as ``classifier``.

        good or bad by the sign of the mean weight, neutral up to ``margin`` (in natural
        logarithms) and for texts without known words; the score is the probability of the label
        that one word of that weight gives, 1 for texts without known words.
        """
        def judge(mean: Column) -> Column:
            label = (F.when(mean > margin * MICRO, F.lit("good")).when(mean < -margin * MICRO, F.lit("bad"))
                     .otherwise(F.lit("neutral")))
            score = F.when(mean.isNull(), 1.0).otherwise(1 / (1 + F.exp(-F.abs(mean) / MICRO)))
            return F.struct(label.alias("label"), score.alias("score"))

        return let(self.mean_weight(text), judge)


def learned_label(df: DataFrame, text: str, label: str,
                  max_words: int = MAX_WORDS) -> Callable[[Column | str], Column]:
    """A classifier for texts, learned from a labelled table."""
    return WordModel(word_weights(df, text, label, max_words)).label


def separation(df: DataFrame, score: str, label: str, steps: int = 1000) -> DataFrame:
    """One row: texts, goods, area -- the chance that a good row scores above a bad one.

    Scores are rounded to ``1 / steps`` and equal ones count half, so only counters per rounded
    score are ordered, never rows. Rows without a label are left out; one class alone gives no area.
    """
    counts = df.filter(F.col(label).isNotNull()).groupBy(F.round(F.col(score) * steps).alias("at")).agg(
        F.sum((F.col(label) > 0).cast("bigint")).alias("good"), F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("bad", F.col("n") - F.col("good"))
    below = F.sum("bad").over(Window.orderBy(F.col("at").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1))
    won = F.col("good") * (F.coalesce(below, F.lit(0)) + F.col("bad") / 2)
    pairs = F.sum("good").cast("double") * F.sum("bad")
    return counts.withColumn("won", won).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("texts"), F.coalesce(F.sum("good"), F.lit(0)).alias("goods"),
        F.when(pairs > 0, F.sum("won") / pairs).alias("area"))
