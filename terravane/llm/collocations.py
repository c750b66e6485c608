"""Collocated phrases, mined by Rabin-Karp fingerprints.

Words are hashed from prefix polynomials over the bytes, phrases of 1 to 4 words from prefix
polynomials over the word hashes, so every n-gram costs a few array operations. Counts are
taken in two passes over the texts:

1. Words, pairs and triples are counted exactly, by 96-bit fingerprints, with the first and last of
   256 blocks of texts that holds them (blocks go by the texts' hashes). The counts of some MB of
   text go out as bytes, one row per hash range. Those that are frequent set three bits each in a
   filter, of 16 bits for each but 32 MB at most, and in a second one together with their blocks.
2. Phrases of four words whose words, pairs and triples all pass the filter are counted the same way,
   with pointers to the first and last text that holds them (by the texts' hashes). Shorter ones
   only get their pointers here, from the texts of their two blocks, so that no task sends all
   the frequent phrases it meets. A phrase can only be frequent if all its parts are, so nothing
   is missed; what passes by chance only costs a row.

Only frequent phrases are then read, where their fingerprints occur in both texts. Where the two
differ, or a text does not hold the fingerprint, different phrases share a fingerprint, and the
whole count is repeated with other polynomials.

A fingerprint includes the language. Occurrences are added up inside tasks before they are
shuffled, so a very common phrase is sent once for some MB of text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terravane import staging
from terravane.llm.ordering import pieces_for, text_bytes
from terravane.llm.textbytes import RunHash, Words, byte_class, lower_ascii, mix, slices, texts

LONGEST = 4
LEAST_COUNT = 30
ABSORBED_PERCENT = 80
TOP = 2000
SCORE_SCALE = 2_000_000
NO_LANGUAGE = "und"
#: Words of the longest phrases that the first pass counts.
_SHORT = LONGEST - 1
#: Bits of a filter: 16 for each frequent word, pair or triple (or each of its blocks), at most 2^28 (32 MB).
FILTER_BITS = 28
_SEGMENT_BITS = 19
#: Looks into the filter for each name.
_LOOKS = 3
#: Fingerprints held by a task before it adds them up.
_HELD = 2 << 20
#: Bytes of text for each hash range of the first pass, on average.
RANGE_BYTES = 8 << 20
#: A text's block: the upper 8 bits of its key, as a signed number like the key.
_BLOCK_SHIFT = 56
#: Phrases with their counts (40 bytes each) that a task holds before it sends them on.
_COUNTED = 1 << 19
#: Rows sent on at once.
_SENT = 1 << 16
#: Bytes of text that are fingerprinted at once; a single longer text is handled alone.
_SLICE = 1 << 20

_BREAK = byte_class((0x2E, 0x2E), (0x2C, 0x2C), (0x3B, 0x3B), (0x3A, 0x3A), (0x21, 0x21), (0x3F, 0x3F),
                    (0x0A, 0x0D))
_WORD = ~(_BREAK | byte_class((0x20, 0x20), (0x09, 0x09)))


class Grams:
    """Fingerprints of the phrases of a text column.

    words: positions of all words. starts(n): index of the first word of every phrase of n words
    that stays inside a piece; names(n), checks(n): their 64-bit and 32-bit fingerprints.
    """

    def __init__(self, text: pa.Array, language: pa.Array, seed: int):
        data, offs = texts(text)
        self.data = lower_ascii(data)
        self.words = Words(self.data, offs, _WORD)
        self.row = self.words.row
        breaks = np.concatenate([[0], np.cumsum(_BREAK[self.data])])[self.words.start]
        self._joined = (breaks[1:] == breaks[:-1]) & (self.row[1:] == self.row[:-1])
        # how many following words are in the piece, up to LONGEST - 1
        self.following = np.zeros(len(self.words), np.int8)
        for _ in range(LONGEST - 1):
            self.following[:-1] = np.where(self._joined, np.minimum(self.following[1:] + 1, LONGEST - 1), 0)
        codes, offs = texts(language)
        self.language = RunHash(4 * seed + 1)(codes, offs[:-1], offs[1:])
        self._sums = [_prefix(RunHash(4 * seed + 2 + i)(self.data, self.words.start, self.words.end), i)
                      for i in (0, 1)]

    def starts(self, n: int) -> np.ndarray:
        return np.flatnonzero(self.following >= n - 1)

    def names(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix(_run(self._sums[0], at, n, 0) ^ self.language[self.row[at]] + np.uint64(n))

    def checks(self, at: np.ndarray, n: int) -> np.ndarray:
        return (mix(_run(self._sums[1], at, n, 1) + self.language[self.row[at]]) >> np.uint64(32)).astype(np.uint32)

    def phrase(self, at: int, n: int) -> str:
        w = self.words
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(
            w.start[at:at + n], w.end[at:at + n], strict=True)).decode()


#: Bases of the two polynomials over word hashes, and their inverses modulo 2^64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BACK = tuple(pow(b, -1, 2**64) for b in _BASES)


def _powers(base: int, size: int) -> np.ndarray:
    steps = np.full(size, base, np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def _prefix(hashes: np.ndarray, which: int) -> np.ndarray:
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _powers(_BASES[which], len(hashes)), out=sums[1:])
    return sums


def _run(sums: np.ndarray, at: np.ndarray, n: int, which: int) -> np.ndarray:
    """Polynomial of the n words from each place, wherever it stands."""
    return (sums[at + n] - sums[at]) * _powers(_BACK[which], len(sums))[at]


#: Odd multipliers whose products' upper bits are the looks into the filter.
_TURNS = (1, 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)


def _turned(names: np.ndarray, turn: int) -> np.ndarray:
    return names * np.uint64(_TURNS[turn])


def _named(docs: DataFrame) -> DataFrame:
    """(key, lang, text): key names a text with its language, equal rows have equal keys."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE))
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64(lang, text).alias("key"), lang.alias("lang"), text.alias("text"))


def _short_added(name, check, n, first, last) -> list[np.ndarray]:
    """Rows of one phrase added up, ascending by name."""
    order = np.argsort(name)
    name, check = name[order], check[order]
    if ((name[1:] == name[:-1]) & (check[1:] != check[:-1])).any():  # phrases that share a name
        inner = np.lexsort((check, name))
        order, name, check = order[inner], name[inner], check[inner]
    start = np.flatnonzero(np.append(True, (name[1:] != name[:-1]) | (check[1:] != check[:-1])))
    return [name[start], check[start], np.add.reduceat(n[order], start),
            np.minimum.reduceat(first[order], start), np.maximum.reduceat(last[order], start)]


#: Columns of the first pass as they are sent, and which of their bytes go together: those that are mostly alike
#: stand apart from the others, as that compresses.
_SENT_AS = {"name": np.uint64, "check": np.uint32, "n": np.uint32, "first": np.int8, "span": np.int8}
_BYTES = (("name", 0, 7), ("name", 7, 8), ("check", 0, 4), ("n", 0, 1), ("n", 1, 4), ("first", 0, 1), ("span", 0, 1))
_PACKED = "part int, " + ", ".join(f"{k}{a} binary" for k, a, _ in _BYTES)


def _packed(columns: list[np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each hash range with names (ascending), in batches of a few MB."""
    name, check, n, first, last = columns
    raw = {k: np.ascontiguousarray(c, _SENT_AS[k]).view(np.uint8).reshape(len(name), -1) for k, c in zip(
        _SENT_AS, (name, check, n, first, last - first), strict=True)}
    cuts = np.concatenate([[0], np.searchsorted(name, edges), [len(name)]])
    parts = np.flatnonzero(np.diff(cuts))
    step = max(1, len(parts) * 4 * _SENT // len(name))
    for i in range(0, len(parts), step):
        part = parts[i:i + step]
        ends = np.append(cuts[part[0]], cuts[part + 1])
        batch = {"part": pa.array(part.astype(np.int32))}
        for k, a, b in _BYTES:
            offsets = ((ends - ends[0]) * (b - a)).astype(np.int32)
            body = np.ascontiguousarray(raw[k][ends[0]:ends[-1], a:b])
            batch[f"{k}{a}"] = pa.Array.from_buffers(pa.binary(), len(part), [
                None, pa.py_buffer(offsets), pa.py_buffer(body)])
        yield pa.record_batch(batch)


def _unpacked(table: pa.Table) -> list[np.ndarray]:
    raw: dict[str, np.ndarray] = {}
    for k, a, b in _BYTES:
        body = np.frombuffer(b"".join(table.column(f"{k}{a}").to_pylist()), np.uint8).reshape(-1, b - a)
        raw.setdefault(k, np.empty((len(body), np.dtype(_SENT_AS[k]).itemsize), np.uint8))[:, a:b] = body
    name, check, n, first, span = (raw[k].view(kind).ravel() for k, kind in _SENT_AS.items())
    return [name, check, n.astype(np.int64), first, first + span]


def short_counts(docs: DataFrame, seed: int, least: int, *, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(name, check, n, first, last) of every word, pair and triple with at least `least` occurrences.

    first, last: the smallest and largest block of a text that holds it. A task sends the counts
    of some MB of text, one row per hash range; a range is added up at once.
    """
    ranges = pieces_for(text_bytes(docs), range_bytes)
    edges = np.array([(2**64 * i) // ranges for i in range(1, ranges)], np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def added() -> Iterator[pa.RecordBatch]:
            name, check, block = (np.concatenate(c) for c in zip(*held, strict=True))
            if len(name):
                yield from _packed(_short_added(name, check, np.ones(len(name), np.int64), block, block), edges)

        for batch in batches:
            for rows in slices(batch, limit=_SLICE):
                grams = Grams(rows.column("text"), rows.column("lang"), seed)
                block = (rows.column("key").to_numpy() >> _BLOCK_SHIFT).astype(np.int8)
                for at, n in ((grams.starts(n), n) for n in range(1, _SHORT + 1)):
                    held.append((grams.names(at, n), grams.checks(at, n), block[grams.row[at]]))
                if sum(len(h[0]) for h in held) > _HELD:
                    yield from added()
                    held = []
        if held:
            yield from added()

    def add_up(table: pa.Table) -> pa.Table:
        columns = _short_added(*_unpacked(table))
        kept = np.flatnonzero(columns[2] >= least)
        name, check, n, first, last = (c[kept] for c in columns)
        return pa.table({"name": name.view(np.int64), "check": check.view(np.int32), "n": n,
                         "first": first, "last": last})

    # as many tasks as ranges, so that a task reads a few of them whatever the input
    return _named(docs).mapInArrow(count, _PACKED).repartition(ranges, "part").groupBy("part").applyInArrow(
        add_up, "name long, check int, n long, first byte, last byte")


def ends_of(short: DataFrame) -> DataFrame:
    """(name): each name with its first and its last block in the upper bits."""
    blocks = short.select("name", F.explode(F.array_distinct(F.array("first", "last"))).alias("block"))
    return blocks.select(F.col("name").bitwiseXOR(F.shiftleft(F.col("block").cast("long"), _BLOCK_SHIFT)).alias("name"))


def bit_filter(names: DataFrame, most_bits: int = FILTER_BITS) -> np.ndarray:
    """Three bits for each name, by hashes of it; as bytes.

    16 bits of size for each name, rounded up to a power of two, at most 2^most_bits: with more names
    the filter passes more, but never stops one. It is made in segments of 64 KB; the segments
    that reach the driver are `2^most_bits / 8` bytes together at most, whatever the names.
    """
    bits = min(max(int(16 * names.count()).bit_length(), _SEGMENT_BITS), most_bits)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            place = batch.column("place").to_numpy()
            order = np.argsort(place)
            place = place[order]
            cuts = np.flatnonzero(np.diff(place >> _SEGMENT_BITS)) + 1
            for part in np.split(place, cuts):
                if len(part):
                    segment = made.setdefault(int(part[0] >> _SEGMENT_BITS), np.zeros(1 << _SEGMENT_BITS - 3, np.uint8))
                    inner = part & (1 << _SEGMENT_BITS) - 1
                    np.bitwise_or.at(segment, inner >> 3, (1 << (inner & 7)).astype(np.uint8))
        for segment, raw in made.items():
            yield pa.record_batch({"segment": pa.array([segment]), "raw": pa.array([raw.tobytes()], pa.binary())})

    def looks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.column("name").to_numpy().view(np.uint64)
            place = np.concatenate([_turned(name, t) for t in range(_LOOKS)]) >> np.uint64(64 - bits)
            yield pa.record_batch({"place": pa.array(place.view(np.int64))})

    segments = names.select("name").mapInArrow(looks, "place long").distinct().repartition(
        F.shiftright("place", _SEGMENT_BITS)).mapInArrow(fill, "segment long, raw binary").collect()
    whole = np.zeros(1 << bits - 3, np.uint8)
    for s in segments:
        at = s["segment"] << _SEGMENT_BITS - 3
        whole[at:at + (1 << _SEGMENT_BITS - 3)] = np.frombuffer(s["raw"], np.uint8)
    return whole


def passes(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    ok = np.ones(len(names), bool)
    for turn in range(_LOOKS):
        left = np.flatnonzero(ok)
        place = _turned(names[left], turn) >> np.uint64(64 - (len(bits).bit_length() + 2))
        ok[left] = bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1
    return ok


_PHRASES = "name long, check int, size int, n long, low long, high long"


def phrase_rows(docs: DataFrame, bits: np.ndarray, seed: int, ends: np.ndarray | None = None) -> DataFrame:
    """Rows of phrase_counts as the tasks send them."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(bits)  # at most 2^FILTER_BITS bits
    shared_ends = None if ends is None else context.broadcast(ends)

    def occurrences(rows: pa.RecordBatch) -> Iterator[np.ndarray]:
        grams = Grams(rows.column("text"), rows.column("lang"), seed)
        key = rows.column("key").to_numpy()
        block = (key >> _BLOCK_SHIFT << _BLOCK_SHIFT).view(np.uint64)
        filled = np.flatnonzero(grams.words.counts)
        yield _table(mix(grams.language[filled]), np.zeros(len(filled), np.uint32), 0,
                     grams.words.counts[filled], key[filled])
        shorter = np.ones(len(grams.words) + 1, bool)  # phrases of n - 1 words, by their first word
        for n in range(1, LONGEST + 1):
            at = grams.starts(n)
            at = at[shorter[at] & shorter[at + 1]] if n > 1 else at
            names = grams.names(at, n)
            if n <= _SHORT:
                ok = passes(shared.value, names)
                at, names = at[ok], names[ok]
                shorter = np.zeros(len(grams.words) + 1, bool)
                shorter[at] = True
                if shared_ends is not None:
                    ok = passes(shared_ends.value, names ^ block[grams.row[at]])
                    at, names = at[ok], names[ok]
            yield _table(names, grams.checks(at, n), n, 1, key[grams.row[at]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, fresh = np.zeros(0, _ROW), []
        for batch in batches:
            for rows in slices(batch, limit=_SLICE):
                fresh += occurrences(rows)
                if sum(map(len, fresh)) > _COUNTED // 2:
                    counted, fresh = _added([counted, *fresh]), []
                    if len(counted) > _COUNTED:
                        yield from _batches(counted)
                        counted = counted[:0]
        yield from _batches(_added([counted, *fresh]))

    return _named(docs).mapInArrow(count, _PHRASES)


def phrase_counts(docs: DataFrame, bits: np.ndarray, seed: int, ends: np.ndarray | None = None) -> DataFrame:
    """(name, check, size, n, low, high) of the phrases that pass the filter, and the languages.

    low, high: the smallest and largest key of a text that holds the phrase. A phrase of size 0
    stands for a language; its count is that of all its words. With `ends`, the filter of the
    names with their blocks, shorter phrases than the longest count only in texts of their first
    and last block: low and high stay the same, n is not the whole count.
    """
    return phrase_rows(docs, bits, seed, ends).groupBy("name", "check", "size").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


_ROW = np.dtype([("name", "i8"), ("check", "i4"), ("size", "i4"), ("n", "i8"), ("low", "i8"), ("high", "i8")])


def _table(name, check, size, n, key) -> np.ndarray:
    out = np.empty(len(name), _ROW)
    out["name"], out["check"], out["size"] = name.view(np.int64), check.view(np.int32), size
    out["n"], out["low"], out["high"] = n, key, key
    return out


def _added(held: list[np.ndarray]) -> np.ndarray:
    """Rows of one phrase added up."""
    rows = np.concatenate(held)
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows["check"], rows["name"]))]
    same = np.ones(len(rows) - 1, bool)
    for column in ("name", "check", "size"):
        same &= rows[column][1:] == rows[column][:-1]
    first = np.flatnonzero(np.append(True, ~same))
    out = rows[first]
    for column, add in (("n", np.add), ("low", np.minimum), ("high", np.maximum)):
        out[column] = add.reduceat(rows[column], first)
    return out


def _batches(columns: np.ndarray | dict) -> Iterator[pa.RecordBatch]:
    """A table in batches of a few MB, as a whole batch is held outside the heap by its reader."""
    names = list(columns if isinstance(columns, dict) else columns.dtype.names)
    for at in range(0, len(columns[names[0]]), _SENT):
        yield pa.record_batch({c: pa.array(np.ascontiguousarray(columns[c][at:at + _SENT])) for c in names})


def read_phrases(docs: DataFrame, counted: DataFrame, seed: int) -> DataFrame:
    """(name, check, size, n, lang, phrase, ok): each fingerprint as both its texts have it.

    ok: the text holds the fingerprint. Pointers go to their texts, which move once; a text
    gets at most as many as it has phrases.
    """
    ends = counted.select("name", "check", "size", "n", F.explode(F.array_distinct(F.array("low", "high"))).alias("key"))
    asked = ends.groupBy("key").agg(F.collect_list(F.struct("name", "check", "size", "n")).alias("asked"))
    own = _named(docs).groupBy("key").agg(F.min(F.struct("lang", "text")).alias("t")).select(
        "key", "t.lang", "t.text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, limit=_SLICE):
                grams = Grams(rows.column("text"), rows.column("lang"), seed)
                column = rows.column("asked")
                asked = pa.Table.from_struct_array(column.flatten())
                name, check, size = (asked.column(c).to_numpy() for c in ("name", "check", "size"))
                row = np.repeat(np.arange(rows.num_rows), column.value_lengths().to_numpy())
                at = np.full(len(name), -1)
                for n in range(1, LONGEST + 1):
                    of = np.flatnonzero(size == n)
                    at[of] = _found(grams, n, row[of], name[of], check[of])
                whole = mix(grams.language[row]).view(np.int64) == name
                ok = np.where(size == 0, whole, at >= 0)
                phrase = [grams.phrase(a, n) if a >= 0 else "" for a, n in zip(at.tolist(), size.tolist(), strict=True)]
                yield pa.record_batch({
                    "name": pa.array(name), "check": pa.array(check), "size": pa.array(size),
                    "n": asked.column("n").combine_chunks(), "lang": rows.column("lang").take(pa.array(row)),
                    "phrase": pa.array(phrase, pa.string()), "ok": pa.array(ok)})

    return own.join(asked, "key").select("lang", "text", "asked").mapInArrow(
        read, "name long, check int, size int, n long, lang string, phrase string, ok boolean")


def _found(grams: Grams, n: int, row: np.ndarray, name: np.ndarray, check: np.ndarray) -> np.ndarray:
    """A place of each asked (row, name, check) among the phrases of n words, -1 if it has none."""
    at = grams.starts(n)
    names = grams.names(at, n).view(np.int64)
    known = np.unique(name)
    code = np.minimum(np.searchsorted(known, names), max(len(known) - 1, 0))
    asked = known[code] == names if len(known) else np.zeros(len(at), bool)
    at, code = at[asked], code[asked]
    places = grams.row[at] * len(known) + code
    order = np.argsort(places, kind="stable")
    places, at = places[order], at[order]
    wanted = row * len(known) + np.searchsorted(known, name)
    first = np.minimum(np.searchsorted(places, wanted), max(len(places) - 1, 0))
    out = np.full(len(row), -1)
    if len(places):
        hit = (places[first] == wanted) & (grams.checks(at[first], n).view(np.int32) == check)
        out[hit] = at[first[hit]]
    return out


def frequent_phrases(docs: DataFrame, *, least: int = LEAST_COUNT, filter_bits: int = FILTER_BITS,
                     tries: int = 8) -> DataFrame:
    """(lang, phrase, size, n): every phrase of 1 to 4 words with at least `least` occurrences.

    Also one row of size 0 per language with the number of all its words. A null text is empty,
    a null language `und`. Words are what spaces and tabs separate inside pieces; pieces end at
    any of . , ; : ! ? and line ends. A-Z are lower-cased, other letters stay.
    """
    spark = docs.sparkSession

    def landed(df: DataFrame, label: str) -> DataFrame:
        path = staging.fresh_path(spark, label)
        df.write.parquet(path)
        return spark.read.parquet(path)

    for seed in range(tries):
        short = landed(short_counts(docs, seed, least), "frequent-short")
        counted = phrase_counts(docs, bit_filter(short, filter_bits), seed, bit_filter(ends_of(short), filter_bits))
        # the first pass has the counts of shorter phrases; what it has not is not frequent
        counted = counted.where(F.col("size").between(1, _SHORT) | (F.col("n") >= least) | (F.col("size") == 0))
        counted = counted.join(short.select("name", "check", F.col("n").alias("whole")), ["name", "check"], "left").where(
            F.col("whole").isNotNull() | ~F.col("size").between(1, _SHORT)).select("name", "check", "size", F.when(
                F.col("size").between(1, _SHORT), F.col("whole")).otherwise(F.col("n")).alias("n"), "low", "high")
        counted = landed(counted, "phrase-counts")
        read = read_phrases(docs, counted, seed).groupBy("name", "check", "size").agg(
            F.min(F.struct("lang", "phrase")).alias("low"), F.max(F.struct("lang", "phrase")).alias("high"),
            F.max("n").alias("n"), F.min("ok").alias("ok"))
        read = landed(read, "phrases")
        if read.where((F.col("low") != F.col("high")) | ~F.col("ok")).isEmpty():
            return read.select(F.col("low.lang").alias("lang"), F.col("low.phrase").alias("phrase"), "size", "n")
    raise RuntimeError(f"phrases share fingerprints under {tries} different polynomials")


def collocations(docs: DataFrame, *, top: int = TOP, absorbed_percent: int = ABSORBED_PERCENT,
                 **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to 4 words of each language.

    a: occurrences of the phrase; l, r: of its parts at the cut that scores lowest (ties: the
    first), where a cut scores floor(2000000 a / (l + r)); n: words of the language. Phrases
    inside a longer frequent one with at least `absorbed_percent` of their occurrences go. Each
    language's first `top` by score, a (both descending) and phrase (UTF-8 bytes).
    """
    known = frequent_phrases(docs, **options)
    words = F.split("phrase", " ")
    candidates = known.where("size >= 2").withColumn("w", words)
    # the longer phrases that hold a phrase, by their most frequent one
    inner = [F.struct(F.lit(i).alias("i"), F.lit(m).alias("m")) for m in range(2, LONGEST)
             for i in range(LONGEST - m + 1)]
    longer = candidates.where("size > 2").select("lang", "w", "size", F.col("n").alias("more"), F.explode(
        F.array(*inner)).alias("x")).where("x.m < size and x.i + x.m <= size").select(
        "lang", F.array_join(F.slice("w", F.col("x.i") + 1, F.col("x.m")), " ").alias("phrase"), "more")
    longer = longer.groupBy("lang", "phrase").agg(F.max("more").alias("more"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.col("more").isNull() | (F.col("more").cast("decimal(20,0)") * 100
                                  < F.col("n").cast("decimal(20,0)") * absorbed_percent))
    cuts = kept.select("lang", "phrase", F.col("n").alias("a"), "w", "size", F.explode(
        F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    for part, count in (("left", "l"), ("right", "r")):
        side = known.where("size > 0").select("lang", F.col("phrase").alias(part), F.col("n").alias(count))
        cuts = cuts.join(side, ["lang", part])
    scaled = F.col("a").cast("decimal(20,0)") * F.lit(SCORE_SCALE).cast("decimal(10,0)")
    cuts = cuts.withColumn("scaled", scaled).withColumn(
        "score", F.expr("scaled div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))").cast("long"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b"))
    order = Window.partitionBy("lang").orderBy(
        F.col("b.score").desc(), F.col("b.a").desc(), F.col("phrase"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = known.where("size = 0").select("lang", F.col("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "b.a", "b.l", "b.r", "n", "b.score")
