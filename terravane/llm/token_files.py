"""Token-id files: frequency-ranked ids, byte-aligned lengths, separate control bytes.

A file is a table of blocks. A block holds whole documents in ascending doc_id order:

    rank_ids   token ids of the block, most frequent first (ties: smaller id first), uint32
    control    two bits per token, four tokens per byte, lowest bits first: bytes - 1
    data       the rank of each token in 1 to 4 bytes, little-endian
    doc_ids    int64 per document;  doc_null: 1 where the doc_id is missing
    doc_tokens int64 per document, the end id counted

Each block ranks its own ids, so one pass tokenises, ranks and writes, and a block can be
read without any other. Decoding looks the four lengths of a control byte up in a table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm.ordering import in_key_order, running_total
from terravane.llm.textbytes import RunHash, byte_class, slices, texts

END_ID = 2
#: Tokens after which a block is closed; a single longer document is a block of its own.
BLOCK_TOKENS = 1 << 20
#: Different chunks that a worker remembers before it starts anew (memory only).
_REMEMBERED = 500_000

BLOCK_SCHEMA = ("part int, block int, n_tokens long, rank_ids binary, control binary, "
                "data binary, doc_ids binary, doc_null binary, doc_tokens binary")

# ---- coding -------------------------------------------------------------------------------

_LENGTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def encode(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(rank_ids, control, data) of an array of ids."""
    if not len(ids):
        return b"", b"", b""
    counts = np.bincount(ids)
    values = np.flatnonzero(counts)
    values = values[np.argsort(-counts[values], kind="stable")]
    rank_of = np.empty(len(counts), np.uint32)
    rank_of[values] = np.arange(len(values), dtype=np.uint32)
    ranks = rank_of[ids]
    lengths = (1 + (ranks > 0xFF) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)).astype(np.uint8)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = lengths - 1
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) < lengths[:, None]
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[used]
    return (values.astype("<u4").tobytes(), control.astype(np.uint8).tobytes(),
            data.tobytes())


def decode(rank_ids: bytes, control: bytes, data: bytes, count: int) -> np.ndarray:
    """The ids that `encode` was given; `count` of them."""
    if count == 0:
        return np.zeros(0, np.uint32)
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    used = np.arange(4, dtype=np.uint8) < lengths[:, None]
    spread = np.zeros((count, 4), np.uint8)
    spread[used] = np.frombuffer(data, np.uint8)
    return np.frombuffer(rank_ids, "<u4")[spread.view("<u4").reshape(-1)]


# ---- tokenising ---------------------------------------------------------------------------

_ASCII_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D))
_PUNCTUATION = byte_class((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_LETTER_OR_DIGIT = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))


def cut_points(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Byte positions where a text may be cut without changing its tokens.

    The byte-level pre-tokeniser never joins a white-space run to what stands before it, so
    the start of each run is a safe cut. Only ASCII white space after a character that cannot
    be white space itself counts: after bytes of the UTF-8 lead C2, E1, E2 or E3 none is cut.
    A run of letters or digits also ends before ASCII punctuation other than an apostrophe.
    """
    if not len(data):
        return np.zeros(0, np.int64)
    space = _ASCII_SPACE[data]
    at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    wide = data[at - 1] >= 0x80
    if wide.any():
        two = data[np.maximum(at - 2, 0)]
        three = data[np.maximum(at - 3, 0)]
        doubtful = wide & ((two == 0xC2) | (three == 0xE1) | (three == 0xE2) | (three == 0xE3))
        at = at[~doubtful]
    # the separators FS to US are white space to some pattern engines only
    at = at[(data[at - 1] < 0x1C) | (data[at - 1] > 0x1F)]
    mark = np.flatnonzero(_PUNCTUATION[data[1:]]) + 1
    plain = _LETTER_OR_DIGIT[data[mark - 1]]
    # Latin-1 letters: lead C3, without the signs for times and division
    plain |= (data[np.maximum(mark - 2, 0)] == 0xC3) & (data[mark - 1] != 0x97) & (
        data[mark - 1] != 0xB7) & (data[mark - 1] >= 0x80) & (mark >= 2)
    marks = np.zeros(len(data), bool)
    marks[at] = True
    marks[mark[plain]] = True
    marks[offs[:-1][np.diff(offs) > 0]] = True
    return np.flatnonzero(marks)


class ChunkTokenizer:
    """Ids of whole texts from the tokenizers library, each different chunk encoded once.

    Texts are cut at `cut_points`; unknown chunks are strung together, encoded by the library
    and split again by the byte length of each token. Two 64-bit hashes name a chunk; if they
    disagree, or lengths do not add up, the text is encoded directly, and so is a text that
    holds the string of an added token, which the library turns into one id.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        size = self.library.get_vocab_size(with_added_tokens=True)
        self.token_bytes = np.zeros(size, np.int64)
        for token, i in self.library.get_vocab(with_added_tokens=True).items():
            self.token_bytes[i] = len(token)  # byte-level: one character per byte
        self.name, self.proof = RunHash(11), RunHash(23)
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.checks = np.zeros(0, np.uint64)
        self.at = np.zeros(1, np.int64)  # token range of each known chunk
        self.ids = np.zeros(0, np.uint32)

    def _encode_all(self, strings: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32)
                for e in self.library.encode_batch_fast(strings, add_special_tokens=False)]

    def _learn(self, data: np.ndarray, start: np.ndarray, end: np.ndarray,
               keys: np.ndarray, checks: np.ndarray) -> None:
        """Encode the chunks data[start:end], which are new."""
        spaced = _ASCII_SPACE[data[start]]
        order = np.argsort(~spaced, kind="stable")
        sizes = (end - start)[order]
        raw = data[_ranges(start[order], sizes)].tobytes()
        ends = np.cumsum(sizes)
        strung = int(spaced.sum())
        total = int(ends[strung - 1]) if strung else 0
        # strung chunks in strings of about 50 kB, the others one by one
        closes = np.searchsorted(ends[:strung], np.arange(50_000, total, 50_000))
        closes = np.unique(np.concatenate([closes, np.arange(strung, len(ends) + 1) - 1]))
        closes = closes[closes >= 0]
        borders = np.concatenate([[0], ends[closes]])
        encoded = self._encode_all([raw[a:b].decode() for a, b in
                                    zip(borders[:-1], borders[1:], strict=True)])
        ids = np.concatenate(encoded)
        cuts = np.searchsorted(np.cumsum(self.token_bytes[ids]), ends, "left") + 1
        lengths = np.empty(len(order), np.int64)
        starts = np.empty(len(order), np.int64)
        lengths[order] = np.diff(cuts, prepend=0)
        starts[order] = cuts - lengths[order]
        keys, checks = np.concatenate([self.keys, keys]), np.concatenate([self.checks, checks])
        starts = np.concatenate([self.at[:-1], len(self.ids) + starts])
        lengths = np.concatenate([np.diff(self.at), lengths])
        ids = np.concatenate([self.ids, ids])
        order = np.argsort(keys, kind="stable")
        self.keys, self.checks = keys[order], checks[order]
        self.ids = ids[_ranges(starts[order], lengths[order])]
        self.at = np.concatenate([[0], np.cumsum(lengths[order])])

    def _with_added(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Which rows hold the string of an added token."""
        out = np.zeros(len(offs) - 1, bool)
        raw = data.tobytes()
        for token in filter(None, self.added):
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offs, at, "right")) - 1
                inside = at + len(token) <= offs[row + 1]  # else it crosses into the next row
                out[row] |= inside
                at = raw.find(token, int(offs[row + 1]) if inside else at + 1)
        return out

    def __call__(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all rows, number of ids of each row), as the library encodes whole texts."""
        added = self._with_added(data, offs)
        if not added.any():
            return self._by_chunks(data, offs)
        sizes = np.diff(offs)
        ids, counts = self._by_chunks(data[np.repeat(~added, sizes)],
                                      np.concatenate([[0], np.cumsum(sizes[~added])]))
        parts: list = [None] * len(added)
        plain = np.split(ids, np.cumsum(counts)[:-1]) if len(counts) else []
        direct = self._encode_all([data[offs[row]:offs[row + 1]].tobytes().decode()
                                   for row in np.flatnonzero(added)])
        for rows, values in ((np.flatnonzero(~added), plain), (np.flatnonzero(added), direct)):
            for row, value in zip(rows, values, strict=True):
                parts[row] = value
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _by_chunks(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = cut_points(data, offs)
        end = np.append(start[1:], len(data))
        keys, checks = self.name(data, start, end), self.proof(data, start, end)
        order = np.argsort(keys)
        ordered = keys[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        names, first = ordered[fresh], order[fresh]
        if len(self.keys) + len(names) > _REMEMBERED:
            self._clear()
        place = np.searchsorted(self.keys, names)
        found = place < len(self.keys)
        found[found] = self.keys[place[found]] == names[found]
        new = np.flatnonzero(~found)
        if len(new):
            at = first[new]
            self._learn(data, start[at], end[at], names[new], checks[at])
            place = np.searchsorted(self.keys, names)
        chunk = np.empty(len(keys), np.int64)
        chunk[order] = place[np.cumsum(fresh) - 1]
        lengths = np.diff(self.at)[chunk]
        ids = self.ids[_ranges(self.at[chunk], lengths)]
        row_first = np.searchsorted(start, offs)
        totals = np.concatenate([[0], np.cumsum(lengths)])
        counts = totals[row_first[1:]] - totals[row_first[:-1]]
        sums = np.concatenate([[0], np.cumsum(self.token_bytes[ids])])
        wrong = self.checks[chunk] != checks
        wrong |= sums[totals[1:]] - sums[totals[:-1]] != end - start
        if not wrong.any():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for row in np.unique(np.searchsorted(offs, start[wrong], "right") - 1):
            parts[row] = self._encode_all([data[offs[row]:offs[row + 1]].tobytes().decode()])[0]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + length)."""
    total = int(lengths.sum())
    shift = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    return np.arange(total) + np.repeat(starts - shift, lengths)


_tokenizers: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """One per worker process and file."""
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


# ---- Spark --------------------------------------------------------------------------------

def token_blocks(docs: DataFrame, tokenizer_path: str, *, end_id: int = END_ID,
                 block_tokens: int = BLOCK_TOKENS, parts: int | None = None) -> DataFrame:
    """Blocks of all documents in ascending doc_id order.

    docs: doc_id, text; other columns are not read. A null text is empty and gives the end id
    only; a null doc_id sorts first; rows with equal doc_ids follow in order of their text.
    An empty table gives no block. A task holds one block and one slice of texts at a time.
    """
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path)
        held: list[tuple] = []
        size = number = part = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate([h[0] for h in held])
            doc_ids, nulls, counts = (np.concatenate([h[i] for h in held]) for i in (1, 2, 3))
            return pa.RecordBatch.from_pylist([dict(zip(names, (
                part, number, len(ids), *encode(ids), doc_ids.astype("<i8").tobytes(),
                nulls.astype(np.uint8).tobytes(), counts.astype("<i8").tobytes(),
            ), strict=True))], schema=schema)

        for batch in batches:
            for rows in slices(batch):
                part = rows.column("_part")[0].as_py()
                ids, counts = encoder(*texts(rows.column("text")))
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, np.uint32(end_id))
                counts = counts + 1
                keys = rows.column("doc_id")
                nulls = np.asarray(keys.is_null())
                keys = np.asarray(keys.fill_null(0))
                ends = np.cumsum(counts)
                row = 0
                while row < len(counts):
                    base = ends[row - 1] if row else 0
                    stop = int(np.searchsorted(ends, base + block_tokens - size, "right"))
                    stop = max(stop, row if held else row + 1)
                    if stop > row:
                        held.append((ids[base:ends[stop - 1]], keys[row:stop], nulls[row:stop],
                                     counts[row:stop]))
                        size += int(ends[stop - 1] - base)
                    if stop < len(counts) or size >= block_tokens:
                        yield close()
                        held, size, number = [], 0, number + 1
                    row = stop
        if held:
            yield close()

    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("n_tokens", pa.int64()),
                        *((n, pa.binary()) for n in ("rank_ids", "control", "data", "doc_ids",
                                                     "doc_null", "doc_tokens"))])
    names = schema.names
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return in_key_order(keyed, "doc_id", parts, ties=["text"]).select(
        "_part", "doc_id", "text").mapInArrow(blocks, BLOCK_SCHEMA)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, **options) -> None:
    """Write the blocks through Spark, so any store that Spark writes to will do."""
    token_blocks(docs, tokenizer_path, **options).write.mode("errorifexists").option(
        "compression", "uncompressed").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids binary: uint32 little-endian), decoded block by block."""
    return _per_document(spark, path, "ids binary", pa.binary(), lambda ids: ids.tobytes())


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) computed from the decoded ids."""
    return _per_document(spark, path, "ids_crc32 long", pa.int64(), lambda ids: zlib.crc32(ids))


def _per_document(spark: SparkSession, path: str, column: str, kind, value) -> DataFrame:
    name = column.split()[0]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in batch.to_pylist():
                ids = np.ascontiguousarray(decode(b["rank_ids"], b["control"], b["data"],
                                                  b["n_tokens"]).astype("<u4"))
                counts = np.frombuffer(b["doc_tokens"], "<i8")
                ends = np.cumsum(counts)
                yield pa.record_batch({
                    "doc_id": pa.array(np.frombuffer(b["doc_ids"], "<i8"), pa.int64(),
                                       mask=np.frombuffer(b["doc_null"], np.uint8) > 0),
                    "start": pa.array(b["_start"] + ends - counts, pa.int64()),
                    "n_tokens": pa.array(counts, pa.int64()),
                    name: pa.array([value(ids[e - n:e]) for e, n in
                                    zip(ends, counts, strict=True)], kind),
                })

    blocks = spark.read.parquet(path)
    starts = running_total(blocks.select("part", "block", "n_tokens"), "part", ["block"],
                           "n_tokens", "_start").select("part", "block", "_start")
    return blocks.join(starts, ["part", "block"]).mapInArrow(
        documents, f"doc_id long, start long, n_tokens long, {column}")
