"""Document fingerprints: invertible Bloom lookup sketches of hashed paragraph cells.

A text is a multiset of paragraph cells, runs of at most four words inside one paragraph
(line); its n-th equal cell has a digest of its own. A sketch adds each 64-bit digest to three
of its cells, which hold a count, a sum of digests and a sum of check values, modulo 2^64.
Subtracting the sketches of two versions leaves the differing digests; peeling the cells that
hold one digest recovers them. If that gets stuck, both are sketched again, four times larger.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.llm.ordering import in_key_order
from terravane.llm.textbytes import RunHash, Words, mix, slices, texts

CELL_WORDS = 4
#: Cells of the sketch that is the fingerprint (three parts of equal size).
CELLS = 12
_GROWTH = 4
_U64 = np.uint64
_run_hash = RunHash(9)


def digests(data: np.ndarray, offs: np.ndarray, cell_words: int = CELL_WORDS
            ) -> tuple[np.ndarray, np.ndarray]:
    """(row, digest) of all paragraph cells of a text column, by row."""
    words = Words(data, offs)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    row = words.row
    breaks = np.flatnonzero(data == 10)
    paragraph = np.searchsorted(breaks, words.start)
    new = np.ones(len(words), bool)
    new[1:] = (row[1:] != row[:-1]) | (paragraph[1:] != paragraph[:-1])
    at = np.arange(len(words))
    first = np.maximum.accumulate(np.where(new, at, 0))
    head = np.flatnonzero((at - first) % cell_words == 0)
    tail = np.append(head[1:], len(words)) - 1
    codes = _run_hash(data, words.start[head], words.end[tail])
    rows = row[head]
    # number equal cells of a row
    order = np.lexsort((codes, rows))
    r, c = rows[order], codes[order]
    fresh = np.ones(len(c), bool)
    fresh[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    at = np.arange(len(c))
    nth = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return r, mix(c + nth.astype(np.uint64) * _U64(0x9E3779B97F4A7C15))


def _check(keys: np.ndarray) -> np.ndarray:
    return mix(keys ^ _U64(0x5851F42D4C957F2D)) & _U64(0xFFFFFFFF)


class Sketches:
    """One sketch per row, in three flat arrays."""

    def __init__(self, rows: int, cells: int):
        self.part = cells // 3
        self.cells = cells
        self.count = np.zeros(rows * cells, np.int64)
        self.keys = np.zeros(rows * cells, np.uint64)
        self.checks = np.zeros(rows * cells, np.uint64)

    def places(self, row: np.ndarray, keys: np.ndarray) -> Iterator[np.ndarray]:
        for j in range(3):
            code = mix(keys + _U64((j + 1) * 0xA24BAED4963EE407 + self.cells & (1 << 64) - 1))
            yield row * self.cells + j * self.part + (code % _U64(self.part)).astype(np.int64)

    def add(self, row: np.ndarray, keys: np.ndarray, sign: int | np.ndarray = 1) -> None:
        factor = np.asarray(sign, np.int64)
        wide = factor.astype(np.uint64)  # -1 becomes 2^64 - 1: subtraction modulo 2^64
        checks = _check(keys) * wide
        signed = keys * wide
        ones = np.broadcast_to(factor, keys.shape)
        for place in self.places(row, keys):
            np.add.at(self.count, place, ones)
            np.add.at(self.keys, place, signed)
            np.add.at(self.checks, place, checks)

    def minus(self, other: Sketches) -> Sketches:
        left = Sketches(0, self.cells)
        left.count = self.count - other.count
        left.keys = self.keys - other.keys
        left.checks = self.checks - other.checks
        return left

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(rows recovered whole, row, digest, sign of each recovered digest); empties self."""
        rows = len(self.count) // self.cells
        found_row, found_key, found_sign = [], [], []
        look = np.flatnonzero(self.count)
        while len(look):
            count = self.count[look]
            single = np.abs(count) == 1
            look, sign = look[single], count[single]
            key = self.keys[look] * sign.astype(np.uint64)
            pure = self.checks[look] * sign.astype(np.uint64) == _check(key)
            look, sign, key = look[pure], sign[pure], key[pure]
            row = look // self.cells
            order = np.lexsort((key, row))
            row, key, sign = row[order], key[order], sign[order]
            fresh = np.ones(len(row), bool)
            fresh[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1])
            row, key, sign = row[fresh], key[fresh], sign[fresh]
            if not len(row):
                break
            found_row.append(row)
            found_key.append(key)
            found_sign.append(sign)
            self.add(row, key, -sign)
            look = np.unique(np.concatenate(list(self.places(row, key))))
        left = (self.count != 0) | (self.keys != 0) | (self.checks != 0)
        done = ~left.reshape(rows, self.cells).any(axis=1) if rows else np.zeros(0, bool)
        if not found_row:
            return done, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return done, *(np.concatenate(x) for x in (found_row, found_key, found_sign))

    def hex(self) -> list[str]:
        """Count (modulo 256), digest sum and check sum of every cell, one text per row."""
        n = len(self.count) // self.cells
        packed = np.empty((n, self.cells, 13), np.uint8)
        packed[:, :, 0] = (self.count & 255).reshape(n, self.cells)
        packed[:, :, 1:9] = self.keys.astype("<u8").view(np.uint8).reshape(n, self.cells, 8)
        low = (self.checks & _U64(0xFFFFFFFF)).astype("<u4")
        packed[:, :, 9:] = low.view(np.uint8).reshape(n, self.cells, 4)
        return [r.tobytes().hex() for r in packed]


def _take(rows: np.ndarray, keys: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the chosen rows (ascending), renumbered 0, 1, ..."""
    number = np.full(int(max(rows.max(initial=-1), chosen.max(initial=-1))) + 1, -1)
    number[chosen] = np.arange(len(chosen))
    keep = number[rows] >= 0
    return number[rows[keep]], keys[keep]


def differences(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray],
                pairs: int, cells: int = CELLS) -> np.ndarray:
    """Number of digests that differ in each pair: row i on the left and row i on the right."""
    out = np.full(pairs, -1, np.int64)
    waiting = np.arange(pairs)
    while len(waiting):
        a = Sketches(len(waiting), cells)
        a.add(*_take(*left, waiting))
        b = Sketches(len(waiting), cells)
        b.add(*_take(*right, waiting))
        done, row, _, _ = a.minus(b).peel()
        counts = np.bincount(row, minlength=len(waiting))
        out[waiting[done]] = counts[done]
        waiting = waiting[~done]
        cells *= _GROWTH  # other places, too: the number of cells enters the hash
    return out


def likeness(differing: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """1 - differing digests by all digests of both texts; two texts without any are alike."""
    return np.where(sizes > 0, 1 - differing / np.maximum(sizes, 1), 1.0)


def fingerprint_edits(docs: DataFrame, *, parts: int | None = None) -> DataFrame:
    """Each row of docs (doc_id, text) with its edited text and the row that follows it.

    Rows follow by ascending doc_id (null first), then text; after the last comes the first.
    The edited text has its last floor(n_chars / 4) code points replaced by the first as many
    (or all) of the next text. Returns doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_cells. Null texts are empty. Other columns
    are not read. A single row is its own next one. A task holds a few megabytes of texts.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_cells", pa.int64())])

    def work(ids: list, whole: list[str]) -> pa.RecordBatch:
        """All rows but the last, which is only the next of the one before."""
        n = len(ids)
        edited = []
        for text, following in zip(whole[:-1], whole[1:], strict=True):
            cut = len(text) // 4
            edited.append(text[:len(text) - cut] + following[:cut])
        own = digests(*texts(pa.array(whole, pa.string())))
        new = digests(*texts(pa.array(edited, pa.string())))
        own_size = np.bincount(own[0], minlength=n + 1)
        new_size = np.bincount(new[0], minlength=n)
        mine = own[0] < n
        print_own, print_new = Sketches(n, CELLS), Sketches(n, CELLS)
        print_own.add(own[0][mine], own[1][mine])
        print_new.add(*new)
        after = own[0] > 0
        follow = own[0][after] - 1, own[1][after]
        first = own[0][mine], own[1][mine]
        return pa.record_batch([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in whole[:-1]], pa.int64()),
            pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
            pa.array(print_own.hex()), pa.array(print_new.hex()),
            pa.array(likeness(differences(first, new, n), own_size[:n] + new_size[:n])),
            pa.array(likeness(differences(first, follow, n), own_size[:n] + own_size[1:n + 1])),
            pa.array(own_size[:n].astype(np.int64)),
        ], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        whole: list[str] = []
        for batch in batches:
            for rows in slices(batch, limit=2 << 20):
                guest = np.asarray(rows.column("_guest"))
                keep = len(guest) if not guest.any() else int(np.argmax(guest)) + 1
                ids += rows.column("doc_id").to_pylist()[:keep]
                whole += [t or "" for t in rows.column("text").to_pylist()[:keep]]
                if len(ids) > 1:
                    yield work(ids[:-1], whole)
                ids, whole = ids[-1:], whole[-1:]
                if keep < len(guest) or guest.any():
                    return

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return in_key_order(keyed, "doc_id", parts, ties=["text"], next_heads=True).select(
        "doc_id", "text", "_guest").mapInArrow(run, ", ".join(
            f"{f.name} {'string' if f.type == pa.string() else 'double' if f.type == pa.float64() else 'long'}"
            for f in schema))
