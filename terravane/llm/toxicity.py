"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence has a score over hashed words and word beginnings: its logistic evidence beyond that
of a sentence that shows nothing, so a long clean document does not add up to a toxic one. A
document is toxic if any sentence is: P = 1 - prod(1 - p_s), noisy-or. The document labels train
the sentence scores through that formula; afterwards the scores point at the offending sentences.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.llm.labelled import TRAIN_ROWS, fit_in_one_task, held_out, training_sample
from terravane.llm.names import by_place, unused
from terravane.llm.textbytes import RunHash, Words, byte_class, lower_ascii, slices, texts

THRESHOLD = 0.7
#: A sentence is pointed at from this score on.
SENTENCE_THRESHOLD = 0.5
#: Chance of a toxic label that no sentence accounts for; only training knows it.
LEAK = 0.02
_BITS = 18
_PREFIXES = (4, 5, 6)
_WORD_BYTES = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
_SENTENCE_END = byte_class((10, 10), (0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
_hashes = [RunHash(31 + k) for k in range(1 + len(_PREFIXES))]


@dataclass
class Sentences:
    """feature: (words, kinds) ids; first: index of the first of them of each sentence, with the
    total; row: of each sentence; begin, end: byte range of each sentence's words."""

    feature: np.ndarray
    first: np.ndarray
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def sentences(data: np.ndarray, offs: np.ndarray) -> Sentences:
    """Sentences (with at least one word) of a text column, with their features.

    A word equal to the one before it in the sentence has no features of its own.
    """
    data = lower_ascii(data)
    words = Words(data, offs, _WORD_BYTES)
    row = words.row
    breaks = np.flatnonzero(_SENTENCE_END[data])
    part = np.searchsorted(breaks, words.start)
    new = np.ones(len(words), bool)
    new[1:] = (row[1:] != row[:-1]) | (part[1:] != part[:-1])
    first = np.append(np.flatnonzero(new), len(words))
    feature = np.empty((len(words), len(_hashes)), np.uint32)
    shift = np.uint64(64 - _BITS)
    for k, code in enumerate(_hashes):
        end = words.end if k == 0 else np.minimum(words.start + _PREFIXES[k - 1], words.end)
        feature[:, k] = code(data, words.start, end) >> shift
    last = first[1:] - 1
    kept = new.copy()  # a word said over and over says no more than once
    kept[1:] |= feature[1:, 0] != feature[:-1, 0]
    return Sentences(feature[kept], np.append(np.flatnonzero(new[kept]), kept.sum()),
                     row[first[:-1]], words.start[first[:-1]], words.end[last])


def evidence(z: np.ndarray, bias: float) -> np.ndarray:
    """-log(1 - p) of sentences with log-odds z, less that of one without any weighted word."""
    return np.maximum(np.logaddexp(0, z) - np.logaddexp(0, bias), 0)


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, s: Sentences, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """(sentence scores, document scores)."""
        if not len(s.row):
            return np.zeros(0), np.zeros(rows)
        z = self.bias + np.add.reduceat(self.weights[s.feature].sum(axis=1, dtype=np.float64), s.first[:-1])
        q = evidence(z, self.bias)
        return -np.expm1(-q), -np.expm1(-np.bincount(s.row, q, minlength=rows))


def fit(table: pa.Table, *, epochs: int = 8, batch: int = 128, rate: float = 1.0,
        min_docs: int = 5, seed: int = 7) -> bytes:
    """Adagrad on the noisy-or likelihood of documents: columns text, y, weight.

    Weights stay at or above zero: a word can make a sentence toxic, but no other word undoes
    it. Features of fewer than `min_docs` toxic documents keep the weight zero.
    """
    weights = np.zeros(1 << _BITS)
    y = np.asarray(table.column("y"), np.float64)
    share = np.asarray(table.column("weight"), np.float64)
    model = Model(weights, -6.0)  # words worth six in log-odds make a sentence doubtful
    if len(y) and y.min() < y.max():
        share = share / share.mean()
        parts = [sentences(*texts(rows.column("text"))) for rows in slices(table)]
        base = np.cumsum([0] + [rows.num_rows for rows in slices(table)])
        feature = np.concatenate([p.feature for p in parts])
        at = np.cumsum([0] + [len(p.feature) for p in parts])
        first = np.concatenate([p.first[:-1] + at[i] for i, p in enumerate(parts)])
        row = np.concatenate([p.row + base[i] for i, p in enumerate(parts)])
        ends = np.append(first[1:], len(feature))
        of_row = np.searchsorted(row, np.arange(len(y) + 1))
        held = np.zeros(len(weights), np.int64)  # toxic documents with each feature
        for i, p in enumerate(parts):
            doc_of = np.repeat(p.row, np.diff(p.first))
            toxic = y[base[i] + doc_of] > 0
            pairs = np.unique(doc_of[toxic][:, None] * (1 << _BITS) + p.feature[toxic].astype(np.int64))
            held += np.bincount(pairs & (1 << _BITS) - 1, minlength=len(weights))
        usable = held >= min_docs
        del parts
        squares = np.full(len(weights), 1e-2)
        random = np.random.Generator(np.random.PCG64(seed))
        for _ in range(epochs):
            order = random.permutation(len(y))
            for i in range(0, len(order), batch):
                docs = order[i:i + batch]
                docs = docs[of_row[docs + 1] > of_row[docs]]
                if not len(docs):
                    continue
                n_sent = of_row[docs + 1] - of_row[docs]
                sent = np.concatenate([np.arange(a, b) for a, b in zip(
                    of_row[docs], of_row[docs + 1], strict=True)])
                n_words = ends[sent] - first[sent]
                shift = np.cumsum(n_words) - n_words
                word = np.arange(int(n_words.sum())) + np.repeat(first[sent] - shift, n_words)
                ids = feature[word]
                z = model.bias + np.add.reduceat(weights[ids].sum(axis=1), shift)
                p = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
                doc_first = np.cumsum(n_sent) - n_sent
                q = LEAK + np.add.reduceat(evidence(z, model.bias), doc_first)
                slope = np.where(y[docs] > 0, -np.exp(-q) / -np.expm1(-q), 1.0) * share[docs]
                g = np.clip(p * np.repeat(slope, n_sent), -5, 5) / len(docs) * 16
                used, place = np.unique(ids, return_inverse=True)
                spread = np.repeat(np.repeat(g, n_words), ids.shape[1])
                gw = np.bincount(place.reshape(-1), spread) * usable[used]
                squares[used] += gw * gw
                weights[used] = np.maximum(weights[used] - rate * gw / np.sqrt(squares[used]), 0)
    return pickle.dumps((weights.astype(np.float32), float(model.bias)))


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic",
          train_rows: int = TRAIN_ROWS) -> Model:
    """Sentence model from at most `train_rows` document labels outside the held-out fold.

    Without labels of both classes the model gives every sentence the score 0.
    """
    return Model(*pickle.loads(fit_in_one_task(training_sample(docs, labels, label, train_rows), fit)))


SCORED = ("score", "n_sentences", "offending")


def score(docs: DataFrame, model: Model, *, keep: list[str] = ("doc_id",)) -> DataFrame:
    """`keep` columns of docs plus score, n_sentences and offending.

    Every row is scored over its whole text. offending: sentences with a score of at least
    SENTENCE_THRESHOLD, as code point ranges of their words. Null, empty and wordless texts
    have score 0 and no sentence. Columns named like the results are replaced.
    """
    return _score(docs, model, [c for c in keep if c not in SCORED], SCORED)


def _score(docs: DataFrame, model: Model, names: list[str], made: Sequence[str]) -> DataFrame:
    """Columns `names` of docs, and what SCORED says under the names `made`."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # 1 MB, fixed
    picked = by_place(docs, names)
    source = f"c{names.index('text')}" if "text" in names else "text"
    columns = [c for c in picked.columns if c != "text"]
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, source):
                data, offs = texts(rows.column(source))
                found = sentences(data, offs)
                each, whole = shared.value.scores(found, rows.num_rows)
                bad = np.flatnonzero(each >= SENTENCE_THRESHOLD)
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                row = found.row[bad]
                origin = points[offs[row]]
                listed = pa.ListArray.from_arrays(
                    np.searchsorted(row, np.arange(rows.num_rows + 1)).astype(np.int32),
                    pa.StructArray.from_arrays(
                        [pa.array(points[found.begin[bad]] - origin, pa.int64()),
                         pa.array(points[found.end[bad]] - origin, pa.int64()), pa.array(each[bad])],
                        ["begin", "end", "score"])).cast(kind)
                yield pa.record_batch(
                    [rows.column(n) for n in columns] + [
                        pa.array(whole), pa.array(np.bincount(found.row, minlength=rows.num_rows)
                                                  .astype(np.int64)), listed],
                    names=[*columns, *SCORED])

    sentence = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()),
                             T.StructField("score", T.DoubleType())])
    kinds = (T.DoubleType(), T.LongType(), T.ArrayType(sentence))
    return picked.mapInArrow(run, T.StructType(
        [T.StructField(n, picked.schema[n].dataType) for n in columns]
        + [T.StructField(n, kind) for n, kind in zip(SCORED, kinds, strict=True)])).toDF(*names, *made)


def classify(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD,
             train_rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_sentences, offending) of every row of docs."""
    scored = score(docs, train(docs, labels, train_rows=train_rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"),
                         "n_sentences", "offending")


def without_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD,
                  train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of docs with a score under the threshold, all columns kept as they are."""
    made = unused(docs, *SCORED)
    scored = _score(docs, train(docs, labels, train_rows=train_rows), list(docs.columns), made)
    return scored.where(F.col(made[0]) < threshold).select(*(F.col(f"`{c}`") for c in docs.columns))
