"""Fixed-size vectors gathered from all tasks: sums and bit sets.

Every task sends one compressed vector; vectors meet in a few tasks, which add them as
they arrive, and the driver adds the few sums. What the driver gets, and what is later
broadcast, has the size of one vector, whatever the size of the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.text import mix

MEETING_TASKS = 8


def packed(vector: np.ndarray) -> bytes:
    return zlib.compress(vector.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind)


def add_up(vectors: DataFrame, column: str, size: int, kind: type, bits: bool = False) -> np.ndarray:
    """Sum (or union, for ``bits``) of the packed vectors of ``column``."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, kind)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total = total | unpacked(data, kind) if bits else total + unpacked(data, kind)
        yield pa.record_batch([pa.array([packed(total)], pa.binary())], [column])

    meeting = vectors.select(column).filter(F.col(column).isNotNull()).repartition(MEETING_TASKS)
    total = np.zeros(size, kind)
    for row in meeting.mapInArrow(merge, f"{column} binary").collect():
        part = unpacked(row[0], kind)
        total = total | part if bits else total + part
    return total


class BitSet:
    """Set of 64-bit hashes in a fixed number of bits: no false negatives.

    Used to send only likely matches into an exact join. With more members than bits it
    lets everything pass and the join is as exact, only larger.
    """

    def __init__(self, log_bits: int = 23) -> None:
        self.log_bits = log_bits
        self.words = np.zeros(1 << (log_bits - 6), np.uint64)

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = hashes >> np.uint64(64 - self.log_bits)
        return (cell >> np.uint64(6)).astype(np.int64), np.uint64(1) << (cell & np.uint64(63))

    def add(self, hashes: np.ndarray) -> None:
        at, bit = self.places(hashes)
        np.bitwise_or.at(self.words, at, bit)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at, bit = self.places(hashes)
        return (self.words[at] & bit) != 0


def bit_set(hashes: DataFrame, column: str, log_bits: int = 23, mixed: bool = True) -> BitSet:
    """Bit set of all values of a long column that holds mixed hashes, or plain ones to mix.

    A missing plain value counts as 0.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = BitSet(log_bits)
        for batch in batches:
            values = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            own.add(values if mixed else mix(values))
        yield pa.record_batch([pa.array([packed(own.words)], pa.binary())], ["bits"])

    found = BitSet(log_bits)
    parts = hashes.select(F.col(column).cast("long")).mapInArrow(partial, "bits binary")
    found.words = add_up(parts, "bits", len(found.words), np.uint64, bits=True)
    return found
