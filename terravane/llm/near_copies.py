"""Near copies by SimHash, with an exact check of the Jaccard similarity of five-word shingles.

Fingerprints of five-word shingles are joined as in simhash: the trie self-join links those that
differ in at most four bits, and what reaches each other is a group. The shingle sets of a group
decide which of its texts are near copies. Texts with equal sets are one node from the start.

Four bits find nearly all copies with small edits, but few at a similarity of 0.8 (some ten
bits differ). The others come from bands of minima: texts of similarity s agree in one minimum
with probability s, so in all five of at least one of 25 bands with 1 - (1 - s^5)^25: 0.99995
at 0.8. Bands whose sets the fingerprints have joined already are left out.

From here on, a group of linked fingerprints is a band like the others. The sets of a band meet
in one task, which counts all intersections as products of 0/1 rows and
returns one link per set at most, never pairs. A band of over BLOCK_SETS sets or BLOCK_SHINGLES
shingles is dealt to random blocks of half that first. After that nearly all sets of a group of
copies have one root; the sets of the band outside its largest group then meet all the others,
block by block, so that no pair is left out. What moves is each set once per band and, in large
bands, once more per block of sets that stayed outside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane import staging
from terravane.llm.components import components
from terravane.llm.simhash import ERRORS, Forest, fingerprints_of, link_edges, rows_of_least
from terravane.llm.textbytes import RunHash, Words, combine, lower_ascii, mix, row_sums, slices, texts

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS = 25
BAND_ROWS = 5
#: A block of sets that meet in one task: at most so many, of so many shingles (16 MB) in all,
#: but for the spread of the dealing.
BLOCK_SETS = 1024
BLOCK_SHINGLES = 2 << 20
#: Columns of a 0/1 matrix at once: 16 MB for a full block.
_COLUMNS = 4096

_random = np.random.Generator(np.random.PCG64(20))
_FLIP = _random.integers(0, 2**64, BANDS * BAND_ROWS, np.uint64)
_ODD = _random.integers(0, 2**64, BANDS * BAND_ROWS, np.uint64) | np.uint64(1)
_word_hash = RunHash(31)


def shingle_sets(column: pa.Array, shingle: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all rows, first index of each row and the total).

    A text of fewer words is one shingle, a wordless one has none. ASCII case doesn't count.
    """
    data, offs = texts(column)
    data = lower_ascii(data)
    words = Words(data, offs)
    hashes = _word_hash(data, words.start, words.end)
    number = np.where(words.counts > 0, np.maximum(words.counts - shingle + 1, 1), 0)
    row = np.repeat(np.arange(len(number)), number)
    start = np.arange(len(row)) + np.repeat(words.first[:-1] - (np.cumsum(number) - number), number)
    size = np.minimum(words.counts, shingle)[row]
    value = hashes[start]
    for i in range(1, shingle):
        longer = size > i
        value[longer] = combine(value[longer], hashes[start[longer] + i])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[new], row[new]
    return value, np.searchsorted(row, np.arange(len(number) + 1))


def set_names(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit name of each set, 0 if it is empty."""
    return mix(row_sums(mix(values ^ _FLIP[0]), first) + np.diff(first).astype(np.uint64))


def band_keys(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One key per row and band; the rows must not be empty."""
    keys = np.zeros((len(first) - 1, BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(first) - 1, band, np.uint64)
        for i in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
            key = combine(key, np.minimum.reduceat((values ^ _FLIP[i]) * _ODD[i], first[:-1]))
        keys[:, band] = key
    return keys


def _sketches(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, tie, fp, sim, n, keys) of every row.

    tie: hash of the text, fp: name of its set, sim: its SimHash fingerprint.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                values, first = shingle_sets(rows.column("text"), shingle)
                size = np.diff(first)
                some = size > 0
                keys = np.zeros(0, np.uint64)
                if some.any():
                    keys = band_keys(values, np.append(first[:-1][some], len(values))).reshape(-1)
                ends = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
                yield pa.record_batch({
                    "doc_id": rows.column("doc_id"), "tie": rows.column("tie"),
                    "fp": pa.array(set_names(values, first).view(np.int64)),
                    "sim": pa.array(fingerprints_of(rows.column("text"), shingle).view(np.int64)),
                    "n": pa.array(size.astype(np.int64)),
                    "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64))),
                })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("text").alias("tie")).mapInArrow(
        sketch, "doc_id long, tie long, fp long, sim long, n long, keys array<long>")


def fingerprint_groups(prints: DataFrame, errors: int = ERRORS) -> DataFrame:
    """prints (fp, sim, ...) with key: one for all fingerprints that reach each other.

    They are linked as simhash.near_duplicates links them.
    """
    roots = components(link_edges(prints.select(F.col("sim").alias("fp")), errors))
    return prints.join(roots, prints.sim == roots.node, "left").select(
        *prints.columns, F.xxhash64(F.coalesce("root", "sim"), F.lit("fingerprints")).alias("key"))


def _sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(fp, shingles binary) of the rows that wanted (fp, least) names."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch):
                values, first = shingle_sets(rows.column("text"), shingle)
                yield pa.record_batch({
                    "fp": pa.array(set_names(values, first).view(np.int64)),
                    "shingles": pa.array([values[a:b].tobytes() for a, b in
                                          zip(first[:-1], first[1:], strict=True)], pa.binary()),
                })

    named = wanted.select(F.col("least.doc_id").alias("_id"), F.col("least.tie").alias("_tie"))
    own = docs.select(F.col("doc_id").cast("long").alias("_d"), F.xxhash64("text").alias("_t"), "text")
    return own.join(named, F.col("_d").eqNullSafe(F.col("_id")) & (F.col("_t") == F.col("_tie")),
                    "left_semi").select("text").mapInArrow(
        hashed, "fp long, shingles binary").dropDuplicates(["fp"])


def overlaps(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets, as a square matrix.

    A shingle of only one set is in no intersection; the others are columns of 0/1 rows whose
    products count them, a stretch of columns at a time.
    """
    rows = len(first) - 1
    shared = np.zeros((rows, rows), np.int64)
    row = np.repeat(np.arange(rows), np.diff(first))
    order = np.argsort(values, kind="stable")
    value, row = values[order], row[order]
    new = np.append(True, value[1:] != value[:-1])
    column = np.cumsum(new) - 1
    several = np.bincount(column)[column] > 1
    column, row = np.cumsum(new[several]) - 1 if several.any() else column[:0], row[several]
    at = 0
    while at < len(column):
        stop = int(np.searchsorted(column, column[at] + _COLUMNS))
        held = np.zeros((rows, int(column[stop - 1] - column[at]) + 1), np.float32)
        held[row[at:stop], column[at:stop] - column[at]] = 1
        shared += (held @ held.T).astype(np.int64)
        at = stop
    return shared


def block_links(fps: np.ndarray, values: np.ndarray, first: np.ndarray,
                similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """At most one link (fp, root) per set of a block that joins all similar pairs of it."""
    size = np.diff(first)
    shared = overlaps(values, first)
    close = shared >= similarity * (size[:, None] + size[None, :] - shared) - 1e-9
    forest = Forest(len(fps))
    forest.link(*np.nonzero(np.triu(close, 1)))
    moved = np.flatnonzero(forest.root != np.arange(len(fps)))
    return fps[moved], fps[forest.root[moved]]


def _linked(blocks: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (left, right) from all pairs inside each block (block, fp)."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the last block seen, which may go on
        for batch in batches:
            name = batch.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(name[1:] != name[:-1]) + 1).tolist(), len(name)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[0].column("block")[0].as_py() != name[a]:
                    yield links(held)
                    held = []
                if b > a:
                    held.append(batch.slice(a, b - a))
        if held:
            yield links(held)

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        fps = np.concatenate([p.column("fp").to_numpy() for p in parts])
        raw = [np.frombuffer(s.as_buffer(), np.uint64) for p in parts for s in p.column("shingles")]
        first = np.cumsum([0, *map(len, raw)])
        left, right = block_links(fps, np.concatenate(raw), first, similarity)
        return pa.record_batch({"left": pa.array(left), "right": pa.array(right)})

    return blocks.select("block", "fp").join(sets, "fp").select("block", "fp", "shingles").repartition(
        "block").sortWithinPartitions("block").mapInArrow(join, "left long, right long")


def _dealt(rows: DataFrame, block_sets: int, block_shingles: int) -> DataFrame:
    """Bands (key, fp, c, total) in blocks (block, fp): a large band in several, by hashes of fp."""
    parts = F.greatest(F.ceil(F.col("c") * 2 / block_sets), F.ceil(F.col("total") * 2 / block_shingles))
    parts = F.when((F.col("c") > block_sets) | (F.col("total") > block_shingles), parts).otherwise(1)
    return rows.select(F.xxhash64("key", F.pmod(F.xxhash64("fp", "key"), parts)).alias("block"), "fp")


def _rest(bands: DataFrame, roots: DataFrame, block_sets: int, block_shingles: int) -> DataFrame:
    """Blocks in which the sets outside a band's largest group meet all sets of the band.

    bands: those dealt to several blocks. The sets outside are dealt to `asks` parts, all sets
    of the band to `parts`; every pair of parts is a block.
    """
    size = F.greatest(F.ceil(F.col("c") * 2 / block_sets), F.ceil(F.col("total") * 2 / block_shingles))
    grouped = bands.withColumn("parts", size).join(roots, bands.fp == roots.node, "left").select(
        "key", "fp", "parts", F.coalesce("root", "fp").alias("root"))
    groups = grouped.groupBy("key", "root").agg(F.count("*").alias("size"), F.max("parts").alias("parts"))
    largest = groups.groupBy("key").agg(
        F.max(F.struct("size", "root"))["root"].alias("top"),
        (F.sum("size") - F.max("size")).alias("outside"), F.max("size").alias("most"),
        F.max("parts").alias("parts")).where("outside > 0").select(
        F.col("key").alias("_key"), "top",
        F.ceil(F.col("outside") * F.col("parts") / (F.col("outside") + F.col("most"))).alias("asks"))
    open_rows = grouped.join(largest, grouped.key == largest._key)
    part = F.pmod(F.xxhash64("fp", F.lit("all")), "parts")
    ask = F.pmod(F.xxhash64("fp", F.lit("outside")), "asks")
    members = open_rows.select("key", "fp", part.alias("part"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("asks") - 1)).alias("ask"))
    outside = open_rows.where("root <> top").select("key", "fp", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), ask.alias("ask"))
    return members.unionByName(outside).select(
        F.xxhash64("key", "part", "ask").alias("block"), "fp").distinct()


def near_copies(docs: DataFrame, *, shingle: int = SHINGLE_WORDS, similarity: float = SIMILARITY,
                errors: int = ERRORS, bands: int = BANDS, block_sets: int = BLOCK_SETS,
                block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(fp, root, least): each different shingle set, its group and its first (doc_id, tie).

    Sets are in one group if a chain of pairs with at least `similarity` joins them. Wordless
    texts are one set. Pairs are sought among linked fingerprints and in the first `bands`
    bands of minima.
    """
    spark = docs.sparkSession

    def landed(df: DataFrame, label: str) -> DataFrame:
        path = staging.fresh_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    least = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "tie"))
    nodes = landed(_sketches(docs, shingle).groupBy("fp").agg(
        least.alias("least"), F.min("n").alias("n"), F.min("keys").alias("keys"),
        F.collect_set("sim").alias("sims")), "nodes")
    prints = nodes.where("n > 0").select("fp", "n", F.explode("sims").alias("sim"))
    rows = fingerprint_groups(prints, errors).select(
        "fp", "n", "key", F.lit(True).alias("linked")).distinct().unionByName(
        nodes.select("fp", "n", F.explode(F.slice("keys", 1, bands)).alias("key"), F.lit(False).alias("linked")))
    rows = landed(rows, "band-rows")
    # bands of the same sets are one; two xors of hashes and the count name the sets of a band
    shared = rows.groupBy("key").agg(
        F.count("*").alias("c"), F.sum("n").alias("total"), F.bit_xor(F.xxhash64("fp")).alias("x"),
        F.bit_xor(F.xxhash64("fp", F.lit(1))).alias("y"), F.max("linked").alias("linked")).where("c > 1")
    shared = shared.groupBy("c", "total", "x", "y").agg(
        F.min("key").alias("key"), F.max("linked").alias("linked")).select("key", "c", "total", "linked")
    every = landed(rows.select("key", "fp").join(shared, "key").select("key", "fp", "c", "total", "linked"), "bands")
    sets = landed(_sets(docs, nodes.join(every.select("fp").distinct(), "fp", "left_semi"), shingle),
                  "sets")

    def links_of(some: DataFrame) -> DataFrame:
        return landed(_linked(_dealt(some, block_sets, block_shingles), sets, similarity), "links")

    links = links_of(every.where("linked"))
    roots = components(links)
    others = every.where("not linked").join(roots, F.col("fp") == F.col("node"), "left")
    apart = others.groupBy("key").agg(
        F.min(F.coalesce("root", "fp")).alias("a"), F.max(F.coalesce("root", "fp")).alias("b")).where("a <> b")
    more = links_of(every.join(apart, "key", "left_semi"))
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = components(links)
    large = every.where((F.col("c") > block_sets) | (F.col("total") > block_shingles))
    more = landed(_linked(_rest(large, roots, block_sets, block_shingles), sets, similarity), "links")
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    return nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """docs with one row of each group of near copies, chosen as simhash.one_of_each does."""
    return rows_of_least(docs, near_copies(docs.select("doc_id", "text"), **options))
