"""Stupid-backoff language-model scores over n-gram count tables.

The corpus is dealt into blocks of documents. Each block counts its n-grams of all orders
(keys are 64-bit hashes) and sends them, one row per hash range, to the range's partition,
where the counts of all blocks are added up: the n-gram count table, partitioned by hash. A
block gets back the totals of those of its n-grams that other blocks hold too, as a bit map
over what it sent and the totals of the marked ones; for all others its own count is the
total. So an n-gram crosses the network once per block and not once per
occurrence, and one that every document holds costs no more than any other. Then the n-grams
of each document are looked up and their scores summed per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.ordering import pieces_for, text_bytes
from terravane.llm.textbytes import (
    RunHash,
    Words,
    combine,
    lower_ascii,
    mix,
    pack_planes,
    texts,
    unpack_planes,
)

_CODEC = "zstd"

ORDER = 3
BACKOFF = 0.4
#: Bytes of text in a block, on average.
BLOCK_BYTES = 6 << 20
#: Bits of a key beyond those that number the n-grams: one lookup in 2^30 meets a foreign count.
SPARE_BITS = 30
_U64 = np.uint64
_word_hash = RunHash(3)
#: Key of the number of words, kept like the count of an n-gram.
_ALL_WORDS = np.array([0x0123456789ABCDEF], np.uint64)


class Grams:
    """Keys of the n-grams that end at each word; order k + 1 is keys[k], valid from word k of
    a document on. row, at: document of each word and its place in it."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, order: int, bits: int = 64):
        data = lower_ascii(data)
        words = Words(data, offs)
        shift = _U64(64 - bits)
        self.all_words = _ALL_WORDS >> shift
        code = _word_hash(data, words.start, words.end)
        self.counts, self.row = words.counts, words.row
        self.at = np.arange(len(words)) - np.repeat(words.first[:-1], words.counts)
        self.keys = [mix(code ^ _U64(0xA5A5A5A5)) >> shift]
        chain = code
        for k in range(1, order):
            # the k words before each word and the word itself, left to right
            longer = np.zeros_like(code)
            longer[1:] = combine(chain[:-1], code[1:])
            chain = longer
            self.keys.append(mix(chain + _U64(k)) >> shift)

    def valid(self, k: int) -> np.ndarray:
        return self.at >= k

    def all_keys(self) -> np.ndarray:
        return np.concatenate([keys[self.valid(k)] for k, keys in enumerate(self.keys)])


def block_counts(grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """(keys ascending, counts) of all orders, with the number of words."""
    keys, counts = np.unique(grams.all_keys(), return_counts=True)
    at = np.searchsorted(keys, grams.all_words)
    return (np.insert(keys, at, grams.all_words),
            np.insert(counts.astype(np.uint32), at, np.uint32(len(grams.row))))


def _ranges(keys: np.ndarray, ranges: int, bits: int) -> np.ndarray:
    """Where each of `ranges` equal parts of the key space begins and ends in sorted keys."""
    edges = np.array([(2**bits * i) // ranges for i in range(1, ranges)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _squeeze(values: np.ndarray) -> bytes:
    """Length, then the compressed byte planes."""
    return len(values).to_bytes(8, "little") + pa.compress(
        pack_planes(values), codec=_CODEC, asbytes=True)


def _expand(raw: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little") * np.dtype(dtype).itemsize
    return unpack_planes(pa.decompress(raw[8:], size, codec=_CODEC, asbytes=True), dtype)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Differences of sorted keys."""
    return _squeeze(np.diff(keys, prepend=_U64(0)))


def _unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_expand(raw, np.uint64), dtype=np.uint64)


PACKED = "block int, doc_ids array<long>, sizes binary, body binary"


def _pack_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text, block) to one row per block and batch, texts compressed."""
    for batch in batches:
        block = np.asarray(batch.column("block"))
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(block[order]) != 0)) if len(block) else []
        rows = []
        for a, b in zip(cuts, [*cuts[1:], len(block)], strict=True):
            part = batch.take(pa.array(order[a:b]))
            data, offs = texts(part.column("text"))
            rows.append((int(block[order[a]]), part.column("doc_id").to_pylist(),
                         _squeeze(np.diff(offs)), _squeeze(data)))
        if rows:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(
                zip(*rows, strict=True), (pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary()),
                strict=True)], names=["block", "doc_ids", "sizes", "body"])


def _unpack_docs(table: pa.Table) -> tuple[list, np.ndarray, np.ndarray]:
    """(doc_ids, bytes, row offsets) of a block, its rows in a fixed order."""
    rows = sorted(zip(*(table.column(n).to_pylist() for n in ("doc_ids", "sizes", "body")), strict=True),
                  key=lambda r: r[2])
    sizes = np.concatenate([_expand(r[1], np.int64) for r in rows])
    return (sum((r[0] for r in rows), []), np.concatenate([_expand(r[2], np.uint8) for r in rows]),
            np.concatenate([[0], np.cumsum(sizes)]))


def word_scores(grams: Grams, total_keys: np.ndarray, totals: np.ndarray, *, backoff: float,
                leave_one_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """(score, order used) of each word, score in millionths of a natural logarithm.

    total_keys, totals: counts over the corpus, keys ascending. With leave_one_out the counts
    are those of the corpus without the document. A word that is not in the corpus counts as
    if it had occurred once.
    """
    rows = len(grams.counts)

    def lookup(keys: np.ndarray) -> np.ndarray:
        order = np.argsort(keys)
        out = np.empty(len(keys), np.int64)
        out[order] = totals[np.searchsorted(total_keys, keys[order])]
        return out

    n = np.full(rows, lookup(grams.all_words)[0]) - (grams.counts if leave_one_out else 0)
    counts = []
    for k, keys in enumerate(grams.keys):
        valid = np.flatnonzero(grams.valid(k))
        picked = keys[valid]
        count = np.zeros(len(keys), np.int64)
        if len(valid):
            count[valid] = lookup(picked)
            if leave_one_out:
                order = np.lexsort((picked, grams.row[valid]))
                r, c = grams.row[valid][order], picked[order]
                fresh = np.ones(len(c), bool)
                fresh[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
                start = np.flatnonzero(fresh)
                own = np.diff(np.append(start, len(c)))
                count[valid[order]] -= np.repeat(own, own)
        counts.append(count)
    used = np.zeros(len(grams.row), np.int64)
    for k in range(1, len(grams.keys)):
        used[counts[k] > 0] = k
    top = np.choose(used, counts) if len(counts) > 1 else counts[0]
    before = np.zeros_like(top)
    before[1:] = np.choose(np.maximum(used[1:] - 1, 0), [c[:-1] for c in counts[:-1]]) if len(
        counts) > 1 else 0
    below = np.where(used == 0, np.maximum(n, 1)[grams.row], before)
    possible = np.minimum(grams.at, len(grams.keys) - 1)
    log = np.log(np.maximum(top, 1) / np.maximum(below, 1)) + (possible - used) * np.log(backoff)
    return np.rint(log * 1e6).astype(np.int64), used + 1


def lm_scores(docs: DataFrame, *, order: int = ORDER, backoff: float = BACKOFF,
              leave_one_out: bool = True, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, log_micro, mean_log, backed_off) of every row of docs.

    Words are runs of anything but ASCII white space, A-Z lower-cased. The score of a word is
    count(n-gram) / count(its first words) of the longest n-gram up to `order`, inside the
    document, that the corpus holds, times `backoff` for each order given up; for single words
    count / all words. log_micro: sum over the words of the natural logarithm, each rounded to
    a millionth, so that the sum does not depend on the order of addition. mean_log: per word,
    null without words. backed_off: words scored with a shorter n-gram than possible. The
    corpus is docs; with `leave_one_out`, docs without the scored row. Null and empty texts
    have no words. Repeated rows count as often as they occur. Other columns are not read.
    """
    size = text_bytes(docs)
    blocks = pieces_for(size, block_bytes)
    ranges = pieces_for(size, 2 * block_bytes)
    bits = min(64, (order * size // 6).bit_length() + SPARE_BITS)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.pmod(
        F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))
    dealt = keyed.mapInArrow(_pack_docs, PACKED).repartition(F.col("block"))

    def count(table: pa.Table) -> pa.Table:
        _, data, offs = _unpack_docs(table)
        keys, counts = block_counts(Grams(data, offs, order, bits))
        edges = _ranges(keys, ranges, bits)
        block = table.column("block")[0].as_py()
        rows = [(i, block, _pack_keys(keys[a:b]), _squeeze(counts[a:b]))
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if b > a]
        return pa.table({n: pa.array(c, t) for n, t, c in zip(
            ("range", "block", "keys", "counts"), (pa.int32(), pa.int32(), pa.binary(), pa.binary()),
            zip(*rows, strict=True), strict=True)})

    def add_up(table: pa.Table) -> pa.Table:
        keys = [_unpack_keys(k) for k in table.column("keys").to_pylist()]
        ends = np.cumsum([len(k) for k in keys])
        keys = np.concatenate(keys)
        own = np.concatenate([_expand(c, np.uint32) for c in table.column("counts").to_pylist()])
        by_key = np.argsort(keys, kind="stable")
        ordered = keys[by_key]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        start = np.flatnonzero(fresh)
        sums = np.add.reduceat(own[by_key].astype(np.uint64), start)
        totals = np.empty(len(keys), np.uint64)
        totals[by_key] = np.repeat(sums, np.diff(np.append(start, len(keys))))
        shared = totals > own
        out = [[], [], []]
        for a, b in zip(ends - np.diff(ends, prepend=0), ends, strict=True):
            out[1].append(np.packbits(shared[a:b]).tobytes())
            out[2].append(_squeeze(totals[a:b][shared[a:b]]))
        return pa.table({"block": table.column("block"), "range": table.column("range"),
                         "marks": pa.array(out[1], pa.binary()), "totals": pa.array(out[2], pa.binary())})

    def look_up(docs_of: pa.Table, replies: pa.Table) -> pa.Table:
        doc_ids, data, offs = _unpack_docs(docs_of)
        grams = Grams(data, offs, order, bits)
        keys, counts = block_counts(grams)
        edges = _ranges(keys, ranges, bits)
        totals = counts.astype(np.int64)
        for i, marks, raw in zip(*(replies.column(n).to_pylist() for n in ("range", "marks", "totals")),
                                 strict=True):
            a, b = edges[i], edges[i + 1]
            shared = np.unpackbits(np.frombuffer(marks, np.uint8), count=b - a).astype(bool)
            totals[a:b][shared] = _expand(raw, np.uint64).astype(np.int64)
        score, used = word_scores(grams, keys, totals, backoff=backoff, leave_one_out=leave_one_out)
        rows = len(grams.counts)
        sums = np.concatenate([[0], np.cumsum(score)])
        ends = np.cumsum(grams.counts)
        total = sums[ends] - sums[ends - grams.counts]
        short = used < np.minimum(grams.at, order - 1) + 1
        n = grams.counts
        return pa.table({
            "doc_id": pa.array(doc_ids, pa.int64()), "n_words": pa.array(n.astype(np.int64)),
            "log_micro": pa.array(total.astype(np.int64)),
            "mean_log": pa.array(total / np.maximum(n, 1) / 1e6, mask=n == 0),
            "backed_off": pa.array(np.bincount(grams.row, short, rows).astype(np.int64))})

    tables = dealt.groupBy("block").applyInArrow(
        count, "range int, block int, keys binary, counts binary")
    replies = tables.groupBy("range").applyInArrow(
        add_up, "block int, range int, marks binary, totals binary")
    return dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        look_up, "doc_id long, n_words long, log_micro long, mean_log double, backed_off long")
