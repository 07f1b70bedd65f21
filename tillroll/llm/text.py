"""Words and shingles of many texts at once, as numpy arrays.

A batch of texts is one byte buffer with a line feed after each text. Words are runs of
bytes of one class, and hashing them takes a few passes over the buffer, with no Python
object per word. Buffers are cut at about ``PIECE`` bytes, so memory does not depend on
the batch size; a longer text is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 19
#: A document's shingle has five words (the library's default for near duplicates).
SHINGLE = 5

# Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[list(BLANKS)] = False

ROOT = np.uint64(0x9E3779B97F4A7C15)
ROOT_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit integers over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def byte_values() -> np.ndarray:
    """A 64-bit value per byte; A-Z have those of a-z."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * ROOT)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 ... base**(n-1), modulo 2**64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, PIECE + (PIECE >> 1)), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if n <= 4 * PIECE:
            _powers[int(base)] = known
    return known[:n]


def pieces(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``PIECE`` bytes of text; null texts become empty."""
    at = batch.schema.get_field_index(column)
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PIECE, "right")))
        piece = batch.slice(start, stop - start)
        # Only the texts of a piece are ever copied, not those of the batch.
        yield piece.set_column(at, column, pc.fill_null(piece.column(column), "").cast(pa.large_string()))
        start = stop


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with a line feed after each, and where each text starts (and the end)."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
    together = pa.LargeListArray.from_arrays(pa.array([0, len(texts)], pa.int64()), texts)
    data = pc.binary_join(together, pa.scalar("\n", pa.large_string()))[0].as_buffer()
    return np.frombuffer(data.to_pybytes() + b"\n", np.uint8), bounds


@dataclass
class Words:
    """Words of a piece: byte range and hash of each, and the word range of each text."""

    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of true flags."""
    edges = np.flatnonzero(np.diff(flags.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    return edges[::2], edges[1::2]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every byte range; equal up to the case of A-Z means equal hashes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_values()[data] * powers(ROOT, n), out=sums[1:])
    return mix((sums[end] - sums[start]) * powers(ROOT_INVERSE, n)[start])


def words_of(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray = NOT_BLANK) -> Words:
    """Words of a piece: runs of the bytes that ``is_word`` flags."""
    start, end = runs(is_word[data])
    return Words(start, end, range_hashes(data, start, end), np.searchsorted(start, bounds))


STEP = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    weights = STEP if size <= SHINGLE else mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += hashes[k : k + n] * weights[k]
    return mix(total + np.uint64(size))


def shingle_runs(words: Words) -> Iterator[np.ndarray]:
    """Per text, the hashes of its shingles in order; a shorter text is one shingle."""
    every = run_hashes(words.hashes, SHINGLE)
    for first, last in zip(words.bounds[:-1], words.bounds[1:]):
        if last - first >= SHINGLE:
            yield every[first : last - SHINGLE + 1]
        else:
            yield run_hashes(words.hashes[first:last], int(last - first)) if last > first else every[:0]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def shingle_sets(words: Words) -> Iterator[np.ndarray]:
    """Per text, its distinct shingle hashes in ascending order."""
    return map(distinct, shingle_runs(words))


def word_pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in batches:
        for piece in pieces(batch, column):
            yield piece, words_of(*joined(piece.column(column)))
