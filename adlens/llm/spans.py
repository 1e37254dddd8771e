"""Array helpers used inside Spark tasks: Arrow text columns as one byte
buffer with offsets, words as (start, end) spans of that buffer, and
polynomial prefix hashes that give the hash of any span in two look-ups.

Null texts count as empty everywhere here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Odd multiplier of the polynomial hash modulo 2^64, and its inverse there.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
# ASCII white space, the only word separator of the word contracts.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
WORD = ~SPACE
# Bytes taken per step, so that the arrays of one step stay small.
STEP = 1 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# One 64-bit value per byte value.
BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow text or binary column, and n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def steps(off: np.ndarray, limit: int = STEP):
    """Ranges (a, b) of rows whose bytes together stay near ``limit``; a row
    above it makes a range of its own."""
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, b
        a = b


def ragged(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices of the runs [start, start + length), one after the other."""
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(int(lengths.sum())) + shift


def words(data: np.ndarray, off: np.ndarray, member: np.ndarray = WORD):
    """Starts and ends of the runs of ``member`` bytes that do not cross a
    row, and for each row the index of its first run (n + 1 values)."""
    inside = member[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = off[:-1][off[1:] > off[:-1]]
        first[full] = inside[full]
        full = off[1:][off[1:] > off[:-1]] - 1
        last[full] = inside[full]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """What ``PrefixHash`` needs for up to ``n`` codes, to be shared by the
    steps of one batch."""
    return powers(BASE, n), powers(INVERSE, n + 1)


class PrefixHash:
    """Polynomial prefix hashes of a sequence of 64-bit codes."""

    def __init__(self, codes: np.ndarray, tables: tuple[np.ndarray, np.ndarray] | None = None):
        n = len(codes)
        up, down = tables or power_tables(n)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * up[:n], out=self.prefix[1:])
        self.down = down[:n + 1]

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the spans [start, end)."""
        return (self.prefix[end] - self.prefix[start]) * self.down[start]

    def windows(self, length: int) -> np.ndarray:
        """Hashes of every window of ``length`` symbols."""
        if len(self.prefix) <= length:
            return np.zeros(0, np.uint64)
        return (self.prefix[length:] - self.prefix[:-length]) * self.down[:len(self.prefix) - length]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit hashes of byte spans (equal bytes, equal hash)."""
    return mix(PrefixHash(BYTE_CODE[data]).span(starts, ends) + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, off: np.ndarray):
    """Starts, ends, hashes of all words, and each row's first word."""
    starts, ends, codes, counts = [], [], [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in steps(off):
        part = data[off[a]:off[b]]
        s, e, rows = words(part, off[a:b + 1] - off[a])
        codes.append(mix(PrefixHash(BYTE_CODE[part]).span(s, e) + (e - s).astype(np.uint64)))
        starts.append(s + off[a])
        ends.append(e + off[a])
        counts.append(np.diff(rows))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *starts]), np.concatenate([none, *ends]), np.concatenate(codes), np.cumsum(np.concatenate(counts))


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value in the sorted ``keys``, -1 where absent."""
    if len(keys) == 0:
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def code_of(text: str) -> np.uint64:
    """``span_hashes`` of one whole string."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def codes_of(texts: list[str]) -> np.ndarray:
    """``span_hashes`` of many whole strings."""
    data, off = text_buffer(pa.array(texts, pa.large_string()))
    return span_hashes(data, off[:-1], off[1:])


def batches(table_batches):
    """Arrow record batches without the empty ones."""
    return (b for b in table_batches if b.num_rows)


def small_batches(table_batches, columns=("text",), limit: int = 4 * STEP):
    """Record batches cut to rows whose texts in ``columns`` together take
    about ``limit`` bytes, so that the arrays made from them stay small."""
    for part in batches(table_batches):
        size = sum(np.diff(text_buffer(part.column(c))[1]) for c in columns)
        for a, b in steps(np.concatenate([[0], np.cumsum(size)]), limit):
            yield part.slice(a, b - a)
