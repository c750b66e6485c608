"""Vectorised work on Arrow text columns: byte buffers, words and 64-bit hashes of byte runs.

A text column is seen as one numpy byte array with row offsets. Words are found with byte
masks; the hash of any byte run comes from two entries of a running sum, so the cost is a few
array passes whatever the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once inside a task; a single longer text is handled alone.
SLICE_BYTES = 2 << 20
_PIECE_BYTES = 1 << 18
_U64 = np.uint64


def _odd_constants(count: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(
        1, 2**64, size=count, dtype=np.uint64, endpoint=False) | _U64(1)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Truth table over the 256 byte values, true inside the closed ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Bytes of words that are separated by white space (space, tab to carriage return).
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return _LOWER[data]


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):  # zero chunks stay chunked in some versions
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offs[0]:offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch | pa.Table, column: str = "text",
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch | pa.Table]:
    """Row ranges of a batch with about `limit` bytes of text each (one row at least)."""
    _, offs = texts(batch.column(column))
    row, rows = 0, batch.num_rows
    while row < rows:
        end = int(np.searchsorted(offs, offs[row] + limit, "right")) - 1
        end = min(max(end, row + 1), rows)
        yield batch.slice(row, end - row)
        row = end


class Words:
    """Positions of the words of a text column, in order.

    start, end: byte range of each word; first: index of the first word of each row, with
    the total appended; row: the row of each word.
    """

    def __init__(self, data: np.ndarray, offs: np.ndarray, inside: np.ndarray = NOT_SPACE):
        self.data, self.offs = data, offs
        mask = inside[data]
        before = np.empty_like(mask)
        before[1:] = mask[:-1]
        after = np.empty_like(mask)
        after[:-1] = mask[1:]
        if len(mask):
            edges = offs[:-1][offs[:-1] < len(mask)]
            before[edges] = False
            before[0] = False
            ends = offs[1:][offs[1:] > 0] - 1
            after[ends] = False
            after[-1] = False
        self.start = np.flatnonzero(mask & ~before)
        self.end = np.flatnonzero(mask & ~after) + 1
        self.first = np.searchsorted(self.start, offs)
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)


class RunHash:
    """64-bit hashes of byte runs: a keyed polynomial modulo 2^64, then mixed.

    Independent of where a run lies. `seed` selects one of many independent functions.
    """

    def __init__(self, seed: int = 1):
        keys = _odd_constants(257, seed)
        self._byte = keys[:256]
        base = int(keys[256]) & ~7 | 3
        self._base, self._back = base, pow(base, -1, 2**64)
        self._seed = _U64(base ^ seed)
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self._powers) < size:
            size = max(size, _PIECE_BYTES + 1)
            for name, factor in (("_powers", self._base), ("_inverse", self._back)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end]; runs are in ascending order and may overlap a little."""
        out = np.empty(len(start), np.uint64)
        i = 0
        while i < len(start):
            j = int(np.searchsorted(end, start[i] + _PIECE_BYTES, "right"))
            j = max(j, i + 1)
            low, high = int(start[i]), int(end[i:j].max())
            piece = data[low:high]
            self._grow(len(piece) + 1)
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(self._byte[piece] * self._powers[:len(piece)], out=sums[1:])
            a, b = start[i:j] - low, end[i:j] - low
            value = (sums[b] - sums[a]) * self._inverse[a]
            out[i:j] = mix(value ^ ((b - a).astype(np.uint64) * self._seed))
            i = j
        return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word (a bijection)."""
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U64(32))
    x = x * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def combine(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Order-sensitive hash of two hashes."""
    return mix(left * _U64(0x9E3779B97F4A7C15) + right)


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i+1]] for each row, zero for empty rows."""
    sums = np.zeros(len(values) + 1, values.dtype if values.dtype.kind != "b" else np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]


def pack(*arrays: np.ndarray) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def pack_planes(values: np.ndarray) -> bytes:
    """Byte planes of an array: all lowest bytes, then all next ones; compresses well."""
    width = values.dtype.itemsize
    return values.view(np.uint8).reshape(-1, width).T.tobytes()


def unpack_planes(raw: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)
