"""SimHash near-duplicates by a self-join of binary tries.

Two 64-bit fingerprints that differ in at most `errors` bits (4) have, by the pigeonring
principle, a rotation by a multiple of 8 bits after which the first 8·l bits differ in at most
floor(errors·l / 8) of them, for every l. So the trie of each of the eight rotations is joined
with itself under a budget that grows with depth: 0 errors in the first byte, 1 in the second
and third, and so on. Node pairs are walked together, differing bits add up, and a pair over
its budget is cut with everything below it.

Spark deals the tries out by their 16-bit prefixes: a fingerprint goes to each pair of prefix
nodes within the budget that it belongs to (itself, and the eight prefixes that differ in one
bit of the second byte). Below its prefix a node pair is walked inside a task, all pairs of
the task at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane import staging
from terravane.llm.components import components
from terravane.llm.textbytes import Words, lower_ascii, slices, texts

ERRORS = 4
SHINGLE_WORDS = 4
HASH_SEED = 42
_ROTATIONS = 8
#: Node pairs walked at once, and leaf pairs compared at once.
_WALK = 1 << 18


# ---- fingerprints -------------------------------------------------------------------------

def fingerprints_of(column: pa.Array, shingle: int = SHINGLE_WORDS,
                    seed: int = HASH_SEED) -> np.ndarray:
    """64-bit fingerprints of a text column."""
    data, offs = texts(column)
    data = lower_ascii(data)
    words = Words(data, offs)
    out = np.zeros(len(offs) - 1, np.uint64)
    if not len(words):
        return out
    # words of the whole column joined by single spaces
    sizes = words.end - words.start + 1
    new_end = np.cumsum(sizes) - 1
    new_start = new_end - sizes + 1
    joined = np.full(int(new_end[-1]) + 1, 32, np.uint8)
    inside = np.arange(len(joined))
    inside = inside - np.repeat(new_start - words.start, sizes)
    inside[new_end] = 0
    joined = data[inside]
    joined[new_end] = 32
    raw = joined.tobytes()
    digest = xxhash.xxh64_intdigest
    for row in range(len(out)):
        first, count = int(words.first[row]), int(words.counts[row])
        if count == 0:
            continue
        number = max(count - shingle + 1, 1)
        starts = new_start[first:first + number].tolist()
        last = first + min(shingle, count) - 1
        ends = new_end[last:last + number].tolist()
        hashes = np.array([digest(raw[a:b], seed) for a, b in zip(starts, ends, strict=True)],
                          np.uint64)
        out[row] = majority(hashes)
    return out


def majority(hashes: np.ndarray) -> np.uint64:
    """Each bit: 1 if set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 255):  # 255 rows fit into byte counters
        bits = np.unpackbits(hashes[at:at + 255].view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, *, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, tie, fp) of every row: null, empty and wordless texts have fingerprint 0.

    tie: hash of the text, which tells rows with equal doc_ids apart.
    """
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                yield pa.record_batch({
                    "doc_id": rows.column("doc_id"), "tie": rows.column("tie"),
                    "fp": pa.array(fingerprints_of(rows.column("text"), shingle).view(np.int64)),
                })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("tie")).mapInArrow(
        score, "doc_id long, tie long, fp long")


# ---- the trie self-join -------------------------------------------------------------------

def budgets(errors: int) -> np.ndarray:
    """Errors allowed in the first d bits of a rotation, d = 0..64."""
    depth = np.arange(65)
    box = -(-depth // 8)
    return np.where(depth == 0, 0, errors * box // 8).astype(np.int8)


class Forest:
    """Roots of the distinct fingerprints seen so far, joined at their smallest member."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            keep = a != b
            a, b = a[keep], b[keep]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
            self.root = root


def walk(left: np.ndarray, right: np.ndarray, groups: tuple, same: np.ndarray, errors: int,
         link) -> None:
    """Join pairs of trie nodes below their common depth of 16 bits.

    left, right: sorted rotated fingerprints of all groups, group after group; groups: arrays
    (left from, left to, right from, right to); same: groups whose two nodes are one node.
    link(i, j) gets index arrays of fingerprints within the budget.
    """
    allowed = budgets(errors)
    l0, l1, r0, r1 = groups
    work = [(l0, l1, r0, r1, same)]
    while work:
        l0, l1, r0, r1, same = work.pop()
        if len(l0) > _WALK:
            half = len(l0) // 2
            for cut in (slice(0, half), slice(half, None)):
                work.append(tuple(x[cut] for x in (l0, l1, r0, r1, same)))
            continue
        # bits that the members of both nodes share: paths without a branch are one step
        a, z = left[l0], left[l1 - 1]
        b, y = right[r0], right[r1 - 1]
        depth = np.minimum(_common_bits(a, z), _common_bits(b, y))
        # cut node pairs that are over budget somewhere on the shared path
        alive = np.ones(len(a), bool)
        differing = a ^ b
        for box in range(1, 9):
            at = np.minimum(8 * box, depth)
            seen = np.where(at > 0, differing >> (np.uint64(64) - np.maximum(at, 1).astype(
                np.uint64)), np.uint64(0))
            alive &= (np.bitwise_count(seen) <= allowed[8 * box]) | (at < 8 * (box - 1))
        small = alive & ((l1 - l0) * (r1 - r0) <= 16)
        _compare(left, right, l0[small], l1[small], r0[small], r1[small], same[small], allowed, link)
        go = alive & ~small
        if not go.any():
            continue
        l0, l1, r0, r1, same, depth = (x[go] for x in (l0, l1, r0, r1, same, depth))
        lm = _split(left, l0, l1, depth)
        rm = _split(right, r0, r1, depth)
        new = [(l0, lm, r0, rm, same), (lm, l1, rm, r1, same)]
        crossing = (l0, lm, rm, r1, np.zeros(len(l0), bool))
        other = ~same  # the fourth quarter of one node with itself is the third again
        new += [crossing, (lm[other], l1[other], r0[other], rm[other],
                           np.zeros(int(other.sum()), bool))]
        new = [np.concatenate(x) for x in zip(*new, strict=True)]
        some = (new[0] < new[1]) & (new[2] < new[3])
        work.append(tuple(x[some] for x in new))


def _common_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of leading bits in which a and b agree (64 if equal)."""
    x = a ^ b
    for shift in (1, 2, 4, 8, 16, 32):
        x = x | x >> np.uint64(shift)
    return 64 - np.bitwise_count(x).astype(np.int64)


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First index in each [low, high) whose bit at `depth` is 1; binary search, all at once."""
    shift = (63 - np.minimum(depth, 63)).astype(np.uint64)
    low, high = low.copy(), high.copy()
    while True:
        active = low < high
        if not active.any():
            return low
        middle = (low + high) // 2
        bit = (values[np.minimum(middle, len(values) - 1)] >> shift & np.uint64(1)).astype(bool)
        bit &= depth < 64
        high = np.where(active & bit, middle, high)
        low = np.where(active & ~bit, middle + 1, low)


def _compare(left, right, l0, l1, r0, r1, same, allowed, link) -> None:
    """Leaves of small node pairs, each with each, against the budget of every byte."""
    wide = r1 - r0
    number = (l1 - l0) * wide
    at = 0
    ends = np.cumsum(number)
    while at < len(number):
        base = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, base + 4 * _WALK, "right")), at + 1)
        pick = slice(at, stop)
        n = number[pick]
        which = np.repeat(np.arange(len(n)), n)
        inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i = l0[pick][which] + inner // wide[pick][which]
        j = r0[pick][which] + inner % wide[pick][which]
        keep = ~same[pick][which] | (i < j)
        i, j = i[keep], j[keep]
        differing = left[i] ^ right[j]
        ok = np.bitwise_count(differing) <= allowed[64]
        i, j, differing = i[ok], j[ok], differing[ok]
        for box in range(1, 8):
            ok = np.bitwise_count(differing >> np.uint64(64 - 8 * box)) <= allowed[8 * box]
            i, j, differing = i[ok], j[ok], differing[ok]
        if len(i):
            link(i, j)
        at = stop


def prefix_rows(fps: DataFrame, errors: int = ERRORS) -> DataFrame:
    """(node long, value long, low boolean): each fingerprint in each node pair it belongs to.

    The number of node pairs of a fingerprint is fixed by the budget (72 for four errors).
    """
    allowed = budgets(errors)
    flips = [0] + [1 << i for i in range(8)] if allowed[16] >= 1 else [0]
    if allowed[8] or allowed[16] > 1:
        raise ValueError("up to 7 errors")
    rows = []
    fp = F.col("fp")
    for r in range(_ROTATIONS):
        value = fp if r == 0 else F.shiftleft(fp, 8 * r).bitwiseOR(
            F.shiftrightunsigned(fp, 64 - 8 * r))
        for flip in flips:
            rows.append(F.struct(F.lit(r).alias("r"), F.lit(flip).alias("flip"), value.alias("value")))
    exploded = fps.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
    prefix = F.shiftrightunsigned("value", 48).cast("long")
    other = prefix.bitwiseXOR(F.col("flip").cast("long"))
    return exploded.select(
        (F.least(prefix, other) + F.greatest(prefix, other) * 65536 + F.col("r").cast("long")
         * (1 << 32)).alias("node"), "value", (prefix <= other).alias("low"))


def link_edges(fps: DataFrame, errors: int = ERRORS) -> DataFrame:
    """Edges (left, right) between distinct fingerprints that join all linked ones.

    Each task returns at most one edge per fingerprint and rotation it holds, never all pairs.
    """
    rows = prefix_rows(fps.select("fp").distinct(), errors)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        node, value, low = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False)
                                            for b in got]) for i in range(3))
        value = value.view(np.uint64)
        rotation = (node >> 32).astype(np.uint64) * np.uint64(8)
        plain = np.where(rotation > 0, value >> rotation | value << (np.uint64(64) - rotation)
                         & np.uint64(2**64 - 1), value)
        known, place = np.unique(plain, return_inverse=True)
        forest = Forest(len(known))
        order = np.lexsort((value, ~low, node))
        node, value, low, place = node[order], value[order], low[order], place[order]
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        ends = np.append(first[1:], len(node))
        lows = np.add.reduceat(low.astype(np.int64), first)
        same = (node[first] & 0xFFFF) == (node[first] >> 16 & 0xFFFF)
        middle = first + lows
        groups = (first, np.where(same, ends, middle), np.where(same, first, middle), ends)
        some = (groups[0] < groups[1]) & (groups[2] < groups[3]) & (~same | (ends - first > 1))
        walk(value, value, tuple(g[some] for g in groups), same[some], errors,
             lambda i, j: forest.link(place[i], place[j]))
        moved = np.flatnonzero(forest.root != np.arange(len(known)))
        yield pa.record_batch({
            "left": pa.array(known[moved].view(np.int64)),
            "right": pa.array(known[forest.root[moved]].view(np.int64)),
        })

    spread = rows.repartition(F.col("node"))
    return spread.mapInArrow(join, "left long, right long")


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE_WORDS,
                    errors: int = ERRORS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of docs.

    fingerprint: 16 lowercase hex digits. component_id: the smallest doc_id reachable over
    fingerprints that differ in at most `errors` bits. Null texts count as empty; wordless
    texts have fingerprint 0 and are linked like any other. Rows with a null doc_id are kept;
    they take part in links, but are no component_id unless the whole group has none. Repeated
    rows are returned as often as they occur. Columns other than doc_id and text are not read.
    """
    by_doc, member = _members(docs, shingle, errors)
    least = member.groupBy("root").agg(F.min("least.doc_id").alias("component_id"))
    ids = member.join(least, "root").select("fp", "component_id")
    return by_doc.join(ids, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _members(docs: DataFrame, shingle: int, errors: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tie, fp) of each row, and (fp, root, least) of each fingerprint.

    least: the smallest (doc_id, tie) with the fingerprint, rows without doc_id last.
    """
    spark = docs.sparkSession
    path = staging.fresh_path(spark, "fingerprints")
    fingerprints(docs, shingle=shingle).write.parquet(path)  # one pass over the texts
    by_doc = spark.read.parquet(path)
    by_fp = by_doc.groupBy("fp").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("absent"), "doc_id", "tie")).alias("least"))
    roots = components(link_edges(by_fp, errors))
    member = by_fp.join(roots, by_fp.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    return by_doc, member


def one_of_each(docs: DataFrame, *, shingle: int = SHINGLE_WORDS, errors: int = ERRORS) -> DataFrame:
    """docs with one row of each group of near duplicates, all columns kept.

    The row with the smallest doc_id stays (then the smallest hash of its text; rows without a
    doc_id only if the whole group has none); of equal rows, one.
    """
    _, member = _members(docs.select("doc_id", "text"), shingle, errors)
    return rows_of_least(docs, member)


def rows_of_least(docs: DataFrame, member: DataFrame) -> DataFrame:
    """The row of docs that is the least of each root in member (root, least)."""
    kept = member.groupBy("root").agg(F.min("least").alias("k")).select(
        F.col("k.doc_id").alias("_id"), F.col("k.tie").alias("_tie"))
    # the row is one column here, so that no name of docs can clash
    own = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("_d"),
                      F.xxhash64("text").alias("_t"))
    return own.join(kept, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_tie")),
                    "left_semi").dropDuplicates(["_d", "_t"]).select("row.*")
