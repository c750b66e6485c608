"""Quality by histogram gradient-boosted trees over document statistics.

The trees are full binary trees in flat arrays, so that all documents of a batch step down
all levels with numpy indexing.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.llm.labelled import TRAIN_ROWS, fit_in_one_task, held_out, training_sample
from terravane.llm.names import by_place
from terravane.llm.textbytes import RunHash, Words, byte_class, lower_ascii, row_sums, slices, texts

THRESHOLD = 0.5
_DIGIT = byte_class((0x30, 0x39))
_UPPER = byte_class((0x41, 0x5A))
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_SENTENCE = byte_class((0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
_COMMON_MARK = byte_class((0x2C, 0x2C), (0x3A, 0x3B), (0x22, 0x22), (0x27, 0x29), (0x2D, 0x2D))
_SYMBOL = byte_class((0x23, 0x26), (0x2A, 0x2B), (0x2F, 0x2F), (0x3C, 0x3E), (0x40, 0x40),
                     (0x5B, 0x60), (0x7B, 0x7E))
_BANG = byte_class((0x21, 0x21))
_BAR = byte_class((0x7C, 0x7C))
_WIDE = byte_class((0x80, 0xFF))
_hash = RunHash(5)

STATISTICS = (
    "log_bytes", "log_words", "mean_word", "longest_word", "short_words", "digits", "capitals",
    "letters", "sentence_marks", "common_marks", "symbols", "bangs", "bars", "wide", "marked_words",
    "capital_words", "same_as_before", "distinct_words", "top_word", "words_per_sentence",
    "words_per_line", "distinct_lines", "top_line", "lone_marks", "distinct_pairs",
)


def _distinct_and_top(row: np.ndarray, code: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different codes of each row, and the count of its most frequent one."""
    order = np.lexsort((code, row))
    r, c = row[order], code[order]
    fresh = np.ones(len(r), bool)
    fresh[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    start = np.flatnonzero(fresh)
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, r[start], np.diff(np.append(start, len(r))))
    return np.bincount(r[start], minlength=rows), top


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(rows, len(STATISTICS)) numbers; a wordless text has zeros where words would count."""
    rows = len(offs) - 1
    words = Words(data, offs)
    row, n = words.row, words.counts
    size = np.diff(offs)
    length = words.end - words.start

    def share(table: np.ndarray) -> np.ndarray:
        return row_sums(table[data], offs) / np.maximum(size, 1)

    def per_word(values: np.ndarray) -> np.ndarray:
        return np.bincount(row, values, minlength=rows) / np.maximum(n, 1)

    code = _hash(lower_ascii(data), words.start, words.end)
    inner = row[1:] == row[:-1]
    again = np.append(False, inner & (code[1:] == code[:-1]))
    distinct, top = _distinct_and_top(row, code, rows)
    pair = (code[:-1] * np.uint64(3) + code[1:])[inner]
    pairs, _ = _distinct_and_top(row[:-1][inner], pair, rows)
    plain = ~(_LETTER | _DIGIT)
    marks = np.concatenate([[0], np.cumsum(plain[data])])
    marked = marks[words.end] - marks[words.start]
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, row, length)
    line = Words(data, offs, ~byte_class((10, 10)))
    lines, top_line = _distinct_and_top(line.row, _hash(data, line.start, line.end), rows)
    safe = np.maximum(n, 1)
    return np.column_stack([
        np.log1p(size), np.log1p(n), per_word(length), np.minimum(longest, 1000), per_word(length <= 3),
        share(_DIGIT), share(_UPPER), share(_LETTER), share(_SENTENCE), share(_COMMON_MARK),
        share(_SYMBOL), share(_BANG), share(_BAR), share(_WIDE), per_word(marked > 0),
        per_word(_UPPER[data[words.start]] if len(words) else np.zeros(0)), per_word(again),
        distinct / safe, top / safe, n / (1 + row_sums(_SENTENCE[data], offs)),
        n / np.maximum(line.counts, 1), lines / np.maximum(line.counts, 1),
        top_line / np.maximum(line.counts, 1), per_word(marked == length), pairs / safe,
    ]).astype(np.float32)


@dataclass
class Trees:
    """Node i of a tree has the children 2i + 1 and 2i + 2; the last level holds the leaves."""

    feature: np.ndarray  # (trees, inner nodes) int16
    limit: np.ndarray    # (trees, inner nodes) float32: go left up to it
    value: np.ndarray    # (trees, leaves) float64
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        every = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for feature, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[every, feature[node]] > limit[node])
            out += value[node - inner]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, *, trees: int = 80, depth: int = 4,
          rate: float = 0.15, bins: int = 64, least_weight: float = 5.0, ridge: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss on binned columns."""
    inner = 2**depth - 1
    total = weight.sum()
    mean = np.clip((weight @ y) / total, 1e-3, 1 - 1e-3) if total > 0 else 0.5
    model = Trees(np.zeros((0, inner), np.int16), np.zeros((0, inner), np.float32),
                  np.zeros((0, inner + 1)), float(np.log(mean / (1 - mean))))
    if not len(y) or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins).astype(np.float32))
             for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    n_columns, wide = x.shape[1], bins + 1
    offset = binned + np.arange(n_columns) * wide
    margin = np.full(len(y), model.base)
    made = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = weight * (p - y), weight * p * (1 - p)
        feature, limit = np.zeros(inner, np.int16), np.full(inner, np.inf, np.float32)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first = 2**level - 1
            count = 2**level
            key = ((node - first)[:, None] * (n_columns * wide) + offset).reshape(-1)
            shape = (count, n_columns, wide)
            size = count * n_columns * wide
            gs = np.bincount(key, np.repeat(g, n_columns), size).reshape(shape).cumsum(axis=2)
            hs = np.bincount(key, np.repeat(h, n_columns), size).reshape(shape).cumsum(axis=2)
            ga, ha = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + ridge) + (ga - gs)**2 / (ha - hs + ridge) - ga**2 / (ha + ridge)
            gain[(hs < least_weight * 0.05) | (ha - hs < least_weight * 0.05)] = 0
            flat = gain.reshape(count, -1)
            best = flat.argmax(axis=1)
            for k in range(count):
                column, cut = divmod(int(best[k]), wide)
                if flat[k, best[k]] > 1e-6 and cut < len(edges[column]):
                    feature[first + k], limit[first + k] = column, edges[column][cut]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > limit[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        margin += value[leaf]
        made.append((feature, limit, value))
    return Trees(*(np.stack(a) for a in zip(*made, strict=True)), model.base)


def fit(table: pa.Table) -> bytes:
    """Trees from rows (x: the statistics as float32 bytes, y, weight)."""
    x = np.frombuffer(b"".join(table.column("x").to_pylist()), np.float32).reshape(-1, len(STATISTICS))
    weight = np.asarray(table.column("weight"), np.float64)
    if len(weight):
        weight = weight / weight.mean()
    return pickle.dumps(boost(x, np.asarray(table.column("y"), np.float64), weight))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch):
            x = statistics(*texts(rows.column("text")))
            yield pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary()),
                                   rows.column("y"), rows.column("weight")], names=["x", "y", "weight"])


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality",
          train_rows: int = TRAIN_ROWS) -> Trees:
    """Trees from at most `train_rows` document labels outside the held-out fold.

    Texts are measured where they lie; only their statistics, 100 bytes a document, go to the
    task that fits. Without labels every text scores 0.5; with labels of one class only, near
    that class.
    """
    sample = training_sample(docs, labels, label, train_rows)
    return pickle.loads(fit_in_one_task(
        sample.mapInArrow(_measured, "x binary, y int, weight double"), fit))


def score(docs: DataFrame, model: Trees, *, keep: list[str] = ("doc_id",)) -> DataFrame:
    """`keep` columns of docs plus score; every row over its whole text.

    A null text counts as empty. An existing column named score is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # under 100 kB, fixed
    names = [c for c in keep if c != "score"]
    picked = by_place(docs, names)
    source = f"c{names.index('text')}" if "text" in names else "text"
    columns = [c for c in picked.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, source):
                x = statistics(*texts(rows.column(source)))
                yield pa.record_batch([rows.column(n) for n in columns] + [
                    pa.array(shared.value.scores(x))], names=[*columns, "score"])

    return picked.mapInArrow(run, T.StructType(
        [T.StructField(n, picked.schema[n].dataType) for n in columns]
        + [T.StructField("score", T.DoubleType())])).toDF(*names, "score")


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD,
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs."""
    scored = score(docs, train(docs, labels, train_rows=train_rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
