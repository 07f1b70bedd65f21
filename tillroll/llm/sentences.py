"""Substring dedup: runs of consecutive sentences that occur elsewhere before.

A sentence ends after a word that ends in ``.``, ``!`` or ``?``, or at a line feed.
Sentences of more than ``LONG`` words are cut after words chosen by their hash and between
equal words, so a passage without punctuation has the same cuts in every document. A run starts at each
sentence and takes consecutive ones until it has ``LEAST_SENTENCES`` and ``LEAST_WORDS``.
Words are runs of characters other than blanks, compared with A-Z lower-cased.

Runs with equal hashes are joined over all documents, without those whose first bits occur
once, which is found out before. The first occurrence, by document
and place, stays; sentences covered by any other occurrence are removed, together with
the blanks up to the next sentence. A repetition within one document counts too.

Rows with the same id and the same text are the same document: their runs count once, so
they lose the same sentences. Different texts under one id are documents of their own, in
the order of a hash of the text. Rows without an id come after all others and are told
apart in the same way. Null and empty texts have no run and stay as they are; so do texts
with fewer sentences than a run needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import small_batches
from tillroll.llm.text import NOT_BLANK, ROOT, ROOT_INVERSE, Words, joined, mix, pieces, powers, words_of
from tillroll.llm.passing import likely_and_others, type_list
from tillroll.llm.vectors import BitSet, bit_set
from tillroll.staging import stage

LEAST_SENTENCES = 3
LEAST_WORDS = 12
LONG = 12
#: One word in so many is a cut in a long sentence.
CUT = np.uint64(5)
#: Stands for a missing id, after all others.
NO_ID = (1 << 63) - 1
LOG_BITS = 25
#: Bits of a hash that are left out where repeated runs are looked for.
REST_BITS = np.uint64(24)

ENDS = np.zeros(256, bool)
ENDS[list(b".!?")] = True


def sentence_starts(data: np.ndarray, words: Words) -> np.ndarray:
    """Numbers of the words that start a sentence, over all texts of the piece."""
    n = len(words.start)
    if not n:
        return np.empty(0, np.int64)
    feeds = np.concatenate([[0], np.cumsum(data == 10)])
    after_feed = feeds[words.start[1:]] > feeds[words.end[:-1]]
    ends = ENDS[data[words.end - 1]]
    begins = np.concatenate([[True], ends[:-1] | after_feed])
    at = np.flatnonzero(begins)
    length = np.diff(np.append(at, n))
    in_long = np.repeat(length > LONG, length)
    chosen = (words.hashes[:-1] % CUT == 0) | (words.hashes[:-1] == words.hashes[1:])
    begins[1:] |= in_long[1:] & in_long[:-1] & chosen
    return np.flatnonzero(begins)


class Runs:
    """Runs of sentences of a piece: text, first and last sentence of each, and its hash."""

    def __init__(self, data: np.ndarray, words: Words) -> None:
        self.starts = sentence_starts(data, words)
        n = len(words.start)
        bounds = np.append(self.starts, n)
        self.text_first = np.searchsorted(self.starts, words.bounds)  # sentences of each text
        text = np.searchsorted(words.bounds, self.starts, "right") - 1
        # The sentence that completes the words, and the one that completes the sentences.
        enough_words = np.searchsorted(bounds, self.starts + LEAST_WORDS, "left") - 1
        last = np.maximum(np.arange(len(self.starts)) + LEAST_SENTENCES - 1, enough_words)
        fits = last < self.text_first[text + 1] if len(text) else np.empty(0, bool)
        self.first, self.last, self.text = np.flatnonzero(fits), last[fits], text[fits]
        self.bounds = bounds
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words.hashes * powers(ROOT, n), out=sums[1:]) if n else None
        begin, end = self.starts[self.first], bounds[self.last + 1]
        self.hashes = mix((sums[end] - sums[begin]) * powers(ROOT_INVERSE, n + 1)[begin] + (end - begin).astype(np.uint64))

    @property
    def place(self) -> np.ndarray:
        """Number of the first sentence within its text."""
        return self.first - self.text_first[self.text]


def runs_of_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Words, Runs]]:
    for batch in batches:
        for piece in pieces(batch):
            data, bounds = joined(piece.column("text"))
            words = words_of(data, bounds, NOT_BLANK)
            yield piece, data, words, Runs(data, words)


def short_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(short, n): the first bits of the hashes of a piece's runs, and how often each occurs in it."""
    for _, _, _, runs in runs_of_pieces(batches):
        short, n = np.unique(runs.hashes >> REST_BITS, return_counts=True)
        yield pa.record_batch([pa.array(short.view(np.int64)), pa.array(n.astype(np.int64))], ["short", "n"])


def occurrences(wanted: BitSet):
    """(h, id, copy, place, n) of every run whose hash may be in the bit set ``wanted``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, _, runs in runs_of_pieces(batches):
            keep = wanted.has(runs.hashes)
            ids, copies = (piece.column(name).to_numpy(zero_copy_only=False) for name in ("id", "copy"))
            yield pa.record_batch(
                [
                    pa.array(runs.hashes[keep].view(np.int64)),
                    pa.array(ids[runs.text[keep]]),
                    pa.array(copies[runs.text[keep]]),
                    pa.array(runs.place[keep].astype(np.int32)),
                    pa.array((runs.last - runs.first + 1)[keep].astype(np.int32)),
                ],
                ["h", "id", "copy", "place", "n"],
            )

    return find


OCCURRENCE = "h long, id long, copy long, place int, n int"
#: A document: rows with an equal id and an equal hash of the text.
DOCUMENT = ["id", "copy"]


def with_ids(docs: DataFrame, key: str, text: str, *others: Column) -> DataFrame:
    """(id, copy, text, ...) per row; ``copy`` tells texts with the same id apart."""
    id_ = F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id")
    return docs.select(id_, F.xxhash64(text).alias("copy"), F.col(text).alias("text"), *others)


def repeated_sentences(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, copy, removed) per document that loses sentences.

    ``removed`` has (place, n, first_id): n sentences from place on occur first in
    ``first_id``. Its size is bounded by the document's.
    """
    small_batches(docs.sparkSession)
    rows = with_ids(docs, key, text)
    # Most runs occur once: only the first bits of their hashes are shuffled.
    counts = rows.mapInArrow(short_hashes, "short long, n long").groupBy("short").agg(F.sum("n").alias("n"))
    likely = stage(counts.filter("n > 1").select(F.shiftleft("short", int(REST_BITS)).alias("h")), "likely")
    found = stage(rows.mapInArrow(occurrences(bit_set(likely, "h", LOG_BITS)), OCCURRENCE), "found")
    # Copies of a row are one occurrence, which comes first or not.
    where = F.struct(*DOCUMENT, "place")
    first = found.groupBy("h").agg(F.min(where).alias("first"))
    later = found.join(first, "h").filter(where != F.col("first"))
    removed = F.struct("place", "n", F.col("first.id").alias("first_id"))
    return later.groupBy(*DOCUMENT).agg(F.collect_set(removed).alias("removed"))


SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("first_id", pa.int64()), ("text", pa.string())])
SPAN_TYPE = "array<struct<start: long, stop: long, first_id: long, text: string>>"


def covered(n_sentences: int, removed: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Whether each sentence is removed, and the smallest id that has it first."""
    steps = np.zeros(n_sentences + 1, np.int64)
    source = np.full(n_sentences, NO_ID)
    for run in removed:
        steps[run["place"]] += 1
        steps[run["place"] + run["n"]] -= 1
    for run in removed:
        part = source[run["place"] : run["place"] + run["n"]]
        np.minimum(part, run["first_id"], out=part)
    return np.cumsum(steps[:-1]) > 0, source


def cut_texts(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """The texts without their removed sentences, and the removed spans in code points."""
    for piece, data, words, runs in runs_of_pieces(batches):
        byte_bounds = joined(piece.column("text"))[1]
        texts, spans = [], []
        for i, removed in enumerate(piece.column("removed").to_pylist()):
            begin, end = int(byte_bounds[i]), int(byte_bounds[i + 1] - 1)
            raw = data[begin:end].tobytes()
            own = runs.starts[runs.text_first[i] : runs.text_first[i + 1]]
            gone, source = covered(len(own), removed or [])
            # A sentence reaches to the start of the next one, the last to the end of the text.
            edge = np.append(words.start[own] - begin, end - begin) if len(own) else np.array([0])
            marks = np.flatnonzero(np.diff(gone.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
            kept, found, at = [], [], 0
            for a, b in zip(marks[::2], marks[1::2]):
                start, stop = int(edge[a]), int(edge[b])
                kept.append(raw[at:start])
                before = len(raw[:start].decode())
                part = raw[start:stop].decode()
                found.append({"start": before, "stop": before + len(part), "first_id": int(source[a:b].min()), "text": part})
                at = stop
            texts.append(b"".join([*kept, raw[at:]]).decode())
            spans.append(found)
        yield pa.record_batch(
            [*[piece.column(name) for name in columns], pa.array(texts, pa.string()), pa.array(spans, pa.list_(SPAN))],
            [*columns, "text", "spans"],
        )


def removed_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per removed span: key, start, stop (code points), first_id and the removed text."""
    removed = stage(repeated_sentences(docs, key, text), "removed")
    likely, _ = likely_and_others(with_ids(docs, key, text), removed, "id")
    cut = likely.join(removed, DOCUMENT).mapInArrow(lambda batches: cut_texts(batches, ["id"]), f"id long, text string, spans {SPAN_TYPE}")
    whole = lambda column: F.nullif(F.col(column), F.lit(NO_ID))
    spans = cut.select("id", F.explode("spans").alias("span")).select("id", "span.*")
    return spans.select(whole("id").alias(key), "start", "stop", whole("first_id").alias("first_id"), F.col("text").alias("removed_text"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``documents`` without repeated sentences: text and n_chars change, emptied rows go.

    Only documents that may lose something meet the list of removals; all others pass by.
    """
    removed = stage(repeated_sentences(docs), "removed")
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = with_ids(docs, "doc_id", "text", row).drop("text")
    likely, others = likely_and_others(rows, removed, "id")
    # The row holds the text, which meets the list once.
    touched = likely.join(removed, DOCUMENT, "left").select(F.col("row.text").alias("text"), "row", "removed")
    cut_type = f"row {touched.schema['row'].dataType.simpleString()}, text string, spans {SPAN_TYPE}"
    cut = touched.mapInArrow(lambda batches: cut_texts(batches, ["row"]), cut_type)
    cut = cut.filter((F.size("spans") == 0) | (F.length(F.trim("text")) > 0))
    left = {"text": F.when(F.col("row.text").isNotNull(), F.col("text"))}
    if "n_chars" in docs.columns:
        left["n_chars"] = F.length(left["text"]).cast(docs.schema["n_chars"].dataType)
    whole = [left.get(name, F.col(f"row.`{name}`")).alias(name) for name in docs.columns]
    return others.select("row.*").unionByName(cut.select(*whole))
