"""Words and word windows of whole text columns, as NumPy arrays.

One call handles one Arrow batch. Texts are read as UTF-8 bytes: every separator
used here is an ASCII byte, so byte classes split words exactly as the same
classes split characters. Hashes are 64-bit polynomials (Rabin-Karp) over bytes
and then over words; equal word sequences always get equal hashes.

Null and empty texts have no words. Memory is a small multiple of the batch;
``pieces`` cuts batches so that only a single longer text exceeds the bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Odd multipliers of the byte and the word polynomial.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
SECOND_BASE = 0xA0761D6478BD642F
MASK = (1 << 64) - 1

#: Bytes whose words are hashed at a time.
HASH_BYTES = 1 << 18
#: Bytes of text in a piece; one longer text makes a longer piece.
PIECE_BYTES = 1 << 20


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 byte values belong to words."""
    table = np.zeros(256, dtype=bool)
    for first, last in ranges:
        table[first:last + 1] = True
    return table


#: Everything but blanks and control blanks: the words ``[^\x20\x09-\x0D]+``.
SPACED = ~byte_class((0x09, 0x0D), (0x20, 0x20))
#: Digits, a-z and everything outside ASCII: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
ALPHANUMERIC = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finisher: spreads every input bit over the result."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end, and each text's offsets."""
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str = "text",
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``limit`` bytes of text, or one row."""
    _, offsets = text_bytes(batch.column(column))
    first, n = 0, batch.num_rows
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield batch.slice(first, last - first)
        first = last


@dataclass
class Words:
    """Words of a run of texts: byte spans, hashes, and each text's word range."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def spans(self) -> Iterator[tuple[int, int]]:
        for k in range(len(self.bounds) - 1):
            yield int(self.bounds[k]), int(self.bounds[k + 1])

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def texts(self) -> np.ndarray:
        """For each word, the number of the text it is in."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())

    def word(self, k: int) -> bytes:
        return self.data[self.starts[k]:self.ends[k]].tobytes()

    def joined(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` (exclusive), with one space between."""
        return b" ".join(self.word(k) for k in range(first, last))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(max(count, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 inside: np.ndarray) -> np.ndarray:
    """One polynomial hash per word, a bounded run of bytes at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(starts, starts[first] + HASH_BYTES))
        last = max(last, first + 1)
        lo, hi = int(starts[first]), int(ends[last - 1])
        lengths = ends[first:last] - starts[first:last]
        at = np.zeros(len(lengths), dtype=np.int64)
        np.cumsum(lengths[:-1], out=at[1:])
        values = data[lo:hi][inside[lo:hi]].astype(np.uint64)
        values += np.uint64(1)
        place = np.arange(len(values), dtype=np.int64) - np.repeat(at, lengths)
        values *= _powers(BYTE_BASE, int(lengths.max()))[place]
        sums = np.add.reduceat(values, at)
        out[first:last] = mix(sums + lengths.astype(np.uint64) * np.uint64(SECOND_BASE))
        first = last
    return out


def words(column: pa.Array, word_bytes: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Split and hash all words of a string column."""
    data, offsets = text_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = word_bytes[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    bounds = np.searchsorted(starts, offsets)
    hashes = _word_hashes(data, starts, ends, inside)
    return Words(data, starts, ends, bounds, hashes)


def window_hashes(hashes: np.ndarray, n: int, base: int = WORD_BASE) -> np.ndarray:
    """The Rabin-Karp hash of each run of ``n`` consecutive words.

    Entry i stands for words i to i+n-1. Runs are put together from runs of
    power-of-two lengths, so a window of n words costs about 2 log2(n) passes.
    Windows over the edge of a text are the caller's to leave out.
    """
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    block, size, total, done = hashes, 1, None, 0
    rest = n
    while rest:
        if rest & 1:
            if total is None:
                total = block
            else:
                shifted = block[done:]
                m = min(len(total), len(shifted))
                total = total[:m] * np.uint64(pow(base, size, 1 << 64)) + shifted[:m]
            done += size
        rest >>= 1
        if rest:
            m = len(block) - size
            block = block[:m] * np.uint64(pow(base, size, 1 << 64)) + block[size:]
            size *= 2
    return mix(total[:len(hashes) - n + 1] + np.uint64(n))


def whole_windows(found: Words, n: int) -> np.ndarray:
    """Which of ``window_hashes`` lie within one text."""
    count = max(0, len(found.hashes) - n + 1)
    ok = np.zeros(count, dtype=bool)
    for first, last in zip(found.bounds[:-1], found.bounds[1:], strict=True):
        if last - first >= n:
            ok[first:last - n + 1] = True
    return ok


def covered(length: int, starts: np.ndarray, n: int) -> np.ndarray:
    """Words within any window of ``n`` words that starts at ``starts``."""
    step = np.zeros(length + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + n, length), -1)
    return np.cumsum(step[:-1]) > 0
