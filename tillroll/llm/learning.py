"""What the trained operators share: folds, bounded samples and letters as numbers."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo 4; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4


HELD_OUT = 2


def is_held_out(key: str = "doc_id") -> Column:
    return F.coalesce(fold(key) == HELD_OUT, F.lit(False))


def bounded_sample(df: DataFrame, label: str, key: str, bound: int) -> tuple[DataFrame, dict]:
    """About ``bound`` rows of each label value at most, chosen by a hash of the key, and each label's share.

    A label with fewer rows is taken whole. There are few labels (languages, classes);
    their counts are all that the driver gets.
    """
    counts = {row[0]: row[1] for row in df.groupBy(label).count().collect() if row[0] is not None}
    shares = {value: min(1.0, bound / n) for value, n in sorted(counts.items())}
    if not shares:
        return df.limit(0), shares
    chance = (F.xxhash64(F.lit("sample"), F.col(key)) / float(1 << 64)) + 0.5
    limits = F.create_map(*[F.lit(x) for pair in shares.items() for x in pair])
    return df.filter(F.col(label).isNotNull() & (chance <= limits[F.col(label)])), shares


@cache
def letters() -> np.ndarray:
    """Per code point: 0 no letter, 1 a letter, 2 a mark that may stand within a word."""
    kinds = {"L": 1, "M": 2}
    return np.array([kinds.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts with a line feed after each, and where each text starts (and the end)."""
    bounds = np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])]).astype(np.int64)
    data = ("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, np.uint32), bounds
