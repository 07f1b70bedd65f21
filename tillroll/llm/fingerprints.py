"""Document fingerprints: one-permutation MinHash, optimal densification, b-bit bins.

The distinct five-word shingles of a text (words are runs of bytes other than blanks, A-Z
lower-cased; a shorter text is one shingle) are hashed once. The top bits of a hash choose
one of ``BINS`` bins, the rest competes for the bin's minimum. An empty bin copies the
first non-empty bin of a sequence of bins drawn for it by a hash, the same for all
documents (optimal densification). Each bin keeps ``BITS`` low bits of a mixed minimum;
the fingerprint is their packed form in hexadecimal.

The likeness of two fingerprints is the share of equal bins, corrected for bins that are
equal by chance, between 0 and 1. A text without words has an empty fingerprint, which is
like itself (1) and unlike any other (0). Null texts count as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.text import PIECE, SHINGLE, joined, mix, run_hashes, words_of

LOG_BINS = 8
BINS = 1 << LOG_BINS
BITS = 8
#: Rows are cut into slices of about so many, in the order of their ids, or into the most
#: slices that the driver keeps an edge for; a slice is a stream and may be of any length.
SLICE_ROWS = 250
MOST_SLICES = 20_000
EMPTY = np.uint64((1 << 64) - 1)
LOW = np.uint64((1 << (64 - LOG_BINS)) - 1)


def draws(bins: np.ndarray, attempt: int) -> np.ndarray:
    """The bin that each of ``bins`` tries to copy at this attempt."""
    return (mix(bins.astype(np.uint64) * np.uint64(1 << 32) + np.uint64(attempt)) >> np.uint64(64 - LOG_BINS)).astype(np.int64)


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles, and the number of the text of each."""
    words = words_of(*joined(pa.array(texts, pa.large_string())))
    counts = words.counts
    every = run_hashes(words.hashes, SHINGLE)
    text = np.searchsorted(words.bounds, np.arange(len(every)), "right") - 1
    whole = np.arange(len(every)) + SHINGLE <= words.bounds[text + 1]
    short = [i for i in np.flatnonzero((counts > 0) & (counts < SHINGLE))]
    extra = [run_hashes(words.hashes[words.bounds[i] : words.bounds[i + 1]], int(counts[i])) for i in short]
    return np.concatenate([every[whole], *extra]), np.concatenate([text[whole], np.array(short, np.int64)])


def minima(texts: list[str]) -> np.ndarray:
    """Minimum of every bin of every text, empty bins filled; a text without words is all EMPTY."""
    hashes, text = shingles(texts)
    bins = (hashes >> np.uint64(64 - LOG_BINS)).astype(np.int64)
    table = np.full(len(texts) * BINS, EMPTY)
    np.minimum.at(table, text * BINS + bins, hashes & LOW)
    table = table.reshape(-1, BINS)
    empty = table == EMPTY
    lone = empty.sum(axis=1) == BINS - 1
    table[lone] = table[lone].min(axis=1, keepdims=True)
    rows, at = np.nonzero(empty & ~empty.all(axis=1)[:, None] & ~lone[:, None])
    attempt = 0
    while len(rows):
        source = draws(at, attempt)
        hit = ~empty[rows, source]
        table[rows[hit], at[hit]] = table[rows[hit], source[hit]]
        rows, at = rows[~hit], at[~hit]
        attempt += 1
    return table


def fingerprints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Low bits per bin and text, as (texts, BINS) bytes; and which texts have no words."""
    table = minima(texts)
    # A minimum that fills many bins has other bits in each, so chance matches are independent.
    mixed = mix(table ^ mix(np.arange(1, BINS + 1, dtype=np.uint64)))
    return (mixed & np.uint64((1 << BITS) - 1)).astype(np.uint8), (table == EMPTY).all(axis=1)


def hexadecimal(low: np.ndarray, empty: np.ndarray) -> list[str]:
    return ["" if none else row.tobytes().hex() for row, none in zip(low, empty)]


def likeness(a: np.ndarray, no_a: np.ndarray, b: np.ndarray, no_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity per row."""
    chance = 1.0 / (1 << BITS)
    equal = (a == b).mean(axis=1)
    found = np.clip((equal - chance) / (1 - chance), 0.0, 1.0)
    return np.where(no_a | no_b, (no_a & no_b).astype(float), found)


def fingerprint(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every row with its fingerprint."""
    rows = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias("text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema.fields)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found: list[str] = []
            for a, b in cuts([len(text) for text in texts]):
                found += hexadecimal(*fingerprints(texts[a:b]))
            yield pa.record_batch([*[batch.column(c) for c in columns], pa.array(found, pa.string())], [*columns, "fingerprint"])

    return rows.mapInArrow(add, f"{types}, fingerprint string")


def cuts(sizes: list[int]) -> list[tuple[int, int]]:
    """Ranges of neighbouring texts with about ``PIECE`` characters in all."""
    out, start, total = [], 0, 0
    for i, size in enumerate(sizes):
        if total and total + size > PIECE // 2:
            out.append((start, i))
            start, total = i, 0
        total += size
    return [*out, (start, len(sizes))] if sizes else []


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many characters of the following one, or all."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def send_to_slices(edges: np.ndarray, lowest: int | None):
    """(slice, follower, doc_id, text); the first documents of a slice also follow the slice before."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(edges) + 1
        for batch in batches:
            ids = batch.column("doc_id")
            missing = np.asarray(ids.is_null())
            values = ids.fill_null(0).to_numpy()
            own = np.where(missing, 0, np.searchsorted(edges, values, "right"))
            heads = np.concatenate([[lowest or 0], edges])[own]
            is_head = np.where(own > 0, values == heads, missing if lowest is None else ~missing & (values == heads))
            at = np.flatnonzero(is_head)
            both = batch.take(pa.array(np.concatenate([np.arange(len(own)), at])))
            slices = np.concatenate([own, (own[at] - 1) % n])
            follower = np.concatenate([np.zeros(len(own), bool), np.ones(len(at), bool)])
            yield pa.record_batch(
                [pa.array(slices), pa.array(follower), both.column("doc_id"), both.column("text")],
                ["slice", "follower", "doc_id", "text"],
            )

    return send


def compare_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (slice, follower, doc_id, text) in order; a slice ends with its first follower."""
    number, ended, ids, texts, size = None, False, [], [], 0
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("slice", "follower", "doc_id", "text"))):
            if row[0] != number:
                number, ended, ids, texts, size = row[0], False, [], [], 0
            if ended:
                continue
            ended = row[1]
            ids.append(row[2])
            texts.append(row[3])
            size += len(row[3])
            if len(ids) > 1 and (ended or size > PIECE // 4):
                yield compared(ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])


def compared(ids: list[int], texts: list[str]) -> pa.RecordBatch:
    own, none = fingerprints(texts)
    after = [edited(text, following) for text, following in zip(texts[:-1], texts[1:])]
    changed, changed_none = fingerprints(after)
    return pa.record_batch(
        [
            pa.array(ids[:-1], pa.int64()),
            pa.array([len(text) for text in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(text.encode()).hexdigest() for text in after], pa.string()),
            pa.array(hexadecimal(own[:-1], none[:-1]), pa.string()),
            pa.array(hexadecimal(changed, changed_none), pa.string()),
            pa.array(likeness(own[:-1], none[:-1], changed, changed_none)),
            pa.array(likeness(own[:-1], none[:-1], own[1:], none[1:])),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def neighbour_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness.

    The edited text takes its end from the next document in the order of (doc_id, text),
    null ids first, the last one's from the first; a single document follows itself.
    Repeated rows follow each other. Texts are shuffled once: approximate quantiles of the
    ids cut them into slices, a slice is read in order as a stream, and its first document
    is also sent to the slice before, as the follower of its last one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = rows.agg(F.count(F.lit(1)).alias("rows"), F.count("doc_id").alias("ids"), F.min("doc_id").alias("lowest")).first()
    wanted = min(-(-known["ids"] // SLICE_ROWS), MOST_SLICES)
    edges: list[int] = []
    if wanted > 1:
        # Quantiles are ids that occur, so every edge is the first document of its slice.
        shares = F.array(*[F.lit(i / wanted) for i in range(1, wanted)])
        edges = rows.agg(F.percentile_approx("doc_id", shares, F.lit(20 * wanted))).first()[0]
    lowest = known["lowest"] if known["rows"] == known["ids"] else None
    edges = np.array(sorted({edge for edge in edges if edge != lowest}), np.int64)
    sent = rows.mapInArrow(send_to_slices(edges, lowest), "slice long, follower boolean, doc_id long, text string")
    in_order = sent.repartition("slice").sortWithinPartitions("slice", "follower", F.col("doc_id").asc_nulls_first(), "text")
    return in_order.mapInArrow(compare_neighbours, EDITED)
