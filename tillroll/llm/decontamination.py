"""Benchmark decontamination by question templates.

Benchmark items and documents are read as canonical tokens: numbers, units after a number
and names become typed placeholders, everything else is a literal word, lower-cased.
A word is a run of letters and digits (dots and commas between digits belong to a
number). A name is a capitalised word inside a sentence; neighbouring names are one
placeholder. Every window of ``WINDOW`` tokens with at least ``LITERALS`` literals is a
template; an item with fewer tokens is one window of its own, if it has as many literals.

Template hashes of documents and items are joined. Matches of a document and an item with
the same distance between their places are one alignment, and its slots must be
consistent: a value of the item always stands for the same value in the document, as in
a question with other parameters. Inconsistent alignments are dropped. A document is
contaminated by an item if its consistent alignments hold at least ``NEEDED`` different
windows of the item, or all of them if it has fewer.

Exact copies do not depend on templates, so neither on the reading of a capitalised word
nor on the number of literals: a document that holds all words of an item in a row is
contaminated by it, with all its windows. The first ``LITERALS`` words of the items choose
the places where whole items are looked for. An item of fewer words would be found by
chance in most texts, so it must stand there as a line, a sentence or several of its own.

Before the join, document windows are tested against a bit set of fixed size that holds
all benchmark windows, so hardly any other window is shuffled, however large either side.

Null and empty texts match nothing, nor do items without words. Rows with the same
id count as one document (or item); so do rows without an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import small_batches
from tillroll.llm.text import ROOT, ROOT_INVERSE, joined, mix, pieces, powers, range_hashes, run_hashes, runs
from tillroll.llm.passing import docs_without, row_key
from tillroll.llm.vectors import bit_set
from tillroll.staging import stage

WINDOW = 8
LITERALS = 4
NEEDED = 4
LOG_BITS = 24

ALNUM = np.zeros(256, bool)
ALNUM[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LOWER = np.zeros(256, bool)
LOWER[list(range(97, 123)) + list(range(128, 256))] = True
POINT = np.zeros(256, bool)
POINT[list(b".,")] = True
STOP = np.zeros(256, bool)
STOP[list(b".!?\n")] = True

# Words that are units when they follow a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms "
    "ounce ounces lb lbs pound pounds ton tons tonne tonnes ml l liter liters litre litres gallon gallons "
    "second seconds sec minute minutes min hour hours day days week weeks month months year years "
    "percent degree degrees celsius fahrenheit dollar dollars cent cents euro euros usd eur gbp yen rupees "
    "mph kph kmh hz khz mhz ghz w kw kwh watt watts volt volts amp amps joule joules calorie calories "
    "byte bytes kb mb gb tb bit bits dozen"
).split()


def hash_of(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return range_hashes(data, np.array([0]), np.array([len(data)]))[0]


UNIT_HASHES = np.sort(np.array([hash_of(unit) for unit in UNITS], np.uint64))
LITERAL, NUMBER, UNIT, NAME = 0, 1, 2, 3
PLACEHOLDERS = mix(np.arange(100, 104, dtype=np.uint64))
#: Instead of a window's place: all words of an item, and its first words.
WHOLE, ANCHOR = -1, -2
SALTS = mix(np.arange(200, 202, dtype=np.uint64))


@dataclass
class Tokens:
    """Canonical tokens of several texts: hash, filler hash, whether literal, and texts' ranges; plain words too, and which open a sentence or line."""

    hashes: np.ndarray
    fillers: np.ndarray
    literal: np.ndarray
    bounds: np.ndarray
    words: np.ndarray
    word_bounds: np.ndarray
    opens: np.ndarray


def lowered(texts: pa.Array) -> pa.Array:
    """Lower-cased texts; one whose size in bytes would change stays as it is."""
    low = pc.utf8_lower(texts)
    return pc.if_else(pc.equal(pc.binary_length(low), pc.binary_length(texts)), low, texts)


def canonical(texts: pa.Array) -> Tokens:
    data, bounds = joined(texts)
    word_bytes = ALNUM[data]
    inner = POINT[data]
    inner[1:-1] &= DIGIT[data[:-2]] & DIGIT[data[2:]]
    inner[[0, -1]] = False
    start, end = runs(word_bytes | inner)
    words = range_hashes(joined(lowered(texts))[0], start, end)
    text = np.searchsorted(bounds, start, "right") - 1
    if not len(start):
        none = np.empty(0, np.uint64)
        nowhere = np.zeros(len(bounds), np.int64)
        return Tokens(none, none, np.empty(0, bool), nowhere, none, nowhere, np.empty(0, bool))
    number = DIGIT[data[start]]
    same_text = np.concatenate([[False], text[1:] == text[:-1]])
    after_number = np.concatenate([[False], number[:-1]]) & same_text
    unit = after_number & np.isin(words, UNIT_HASHES)
    stops = np.concatenate([[0], np.cumsum(STOP[data])])
    inside = np.concatenate([[False], stops[start[1:]] == stops[end[:-1]]]) & same_text
    second = data[np.minimum(start + 1, len(data) - 1)]
    name = inside & UPPER[data[start]] & LOWER[second] & (end - start > 1)
    kind = np.select([number, unit, name], [NUMBER, UNIT, NAME], LITERAL)
    # Neighbouring names are one token, whose filler is all of them.
    follows = np.concatenate([[False], name[1:] & name[:-1]]) & same_text
    first = np.flatnonzero(~follows)
    place_in_name = np.arange(len(words)) - np.repeat(first, np.diff(np.append(first, len(words))))
    fillers = np.add.reduceat(words * (place_in_name + 1).astype(np.uint64), first)
    kind = kind[first]
    hashes = np.where(kind == LITERAL, words[first], PLACEHOLDERS[kind])
    return Tokens(
        hashes, fillers, kind == LITERAL, np.searchsorted(start[first], bounds), words, np.searchsorted(start, bounds), ~inside
    )


@dataclass
class WordRuns:
    """Hash of any run of words of the texts, whatever its length."""

    words: np.ndarray

    def __post_init__(self) -> None:
        n = len(self.words)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.words * powers(ROOT, n), out=self.sums[1:])
        self.back = powers(ROOT_INVERSE, n)

    def hashes(self, first: np.ndarray, size: np.ndarray | int, kind: int) -> np.ndarray:
        size = np.asarray(size, np.int64)
        own = (self.sums[first + size] - self.sums[first]) * self.back[first] + size.astype(np.uint64)
        return mix(mix(own) ^ SALTS[kind])


def whole_items(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(h, text, place, n_words) of every item with words, and of its first words."""
    first, counts = tokens.word_bounds[:-1], np.diff(tokens.word_bounds)
    runs_of = WordRuns(tokens.words)
    text = np.flatnonzero(counts)
    anchors = np.minimum(counts[text], LITERALS)
    hashes = [runs_of.hashes(first[text], counts[text], WHOLE), runs_of.hashes(first[text], anchors, ANCHOR)]
    return np.concatenate(hashes), np.tile(text, 2), np.repeat([WHOLE, ANCHOR], len(text)), np.tile(counts[text], 2)


def whole_copies(tokens: Tokens, item_sizes: list[int], wanted) -> tuple[np.ndarray, np.ndarray]:
    """(h, text) of the runs of words that may be a whole item, once per text."""
    runs_of = WordRuns(tokens.words)
    hashes, texts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    opening = np.flatnonzero(tokens.opens)
    closed = np.append(tokens.opens, True)
    for size in item_sizes:
        if size < LITERALS:
            text = np.searchsorted(tokens.word_bounds, opening, "right") - 1
            here = opening + size <= tokens.word_bounds[text + 1]
            here[here] = closed[opening[here] + size]
            hashes.append(runs_of.hashes(opening[here], size, WHOLE))
            texts.append(text[here])
    at = np.arange(max(len(tokens.words) - LITERALS + 1, 0))
    at = at[wanted.has(runs_of.hashes(at, LITERALS, ANCHOR))]
    text = np.searchsorted(tokens.word_bounds, at, "right") - 1
    for size in item_sizes:
        if size < LITERALS:
            continue
        here = at + size <= tokens.word_bounds[text + 1]
        hashes.append(runs_of.hashes(at[here], size, WHOLE))
        texts.append(text[here])
    hashes, texts = np.concatenate(hashes), np.concatenate(texts)
    known = wanted.has(hashes)
    found = np.unique(np.stack([texts[known].astype(np.uint64), hashes[known]], axis=1), axis=0)
    return found[:, 1], found[:, 0].astype(np.int64)


WINDOWS = "h long, id long, place int, n_windows int, slots array<long>"


def window_rows(hashes, ids, place, n_windows, slots) -> pa.RecordBatch:
    return pa.record_batch(
        [
            pa.array(hashes.view(np.int64)),
            ids,
            pa.array(place.astype(np.int32)),
            pa.array(n_windows.astype(np.int32)),
            pa.array(slots, pa.list_(pa.int64())),
        ],
        ["h", "id", "place", "n_windows", "slots"],
    )


def template_windows(sizes: list[int] | None, wanted=None, item_sizes: list[int] = ()):
    """(h, id, place, n_windows, slots) of templates, and of whole items without slots.

    For items ``sizes`` is None: windows of ``WINDOW`` tokens, or of the whole item; rows of
    a whole item have its number of words as n_windows. For documents it lists all window
    sizes in use, ``wanted`` has the templates and whole items asked for, and
    ``item_sizes`` all numbers of words of an item.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                ids = piece.column("id")
                tokens = canonical(piece.column("text"))
                counts = np.diff(tokens.bounds)
                if wanted is None:
                    hashes, text, place, size = whole_items(tokens)
                else:
                    hashes, text = whole_copies(tokens, item_sizes, wanted)
                    place = size = np.full(len(text), WHOLE)
                yield window_rows(hashes, ids.take(pa.array(text)), place, size, [[]] * len(text))
                for size in sizes or sorted({int(n) for n in counts if LITERALS <= n < WINDOW} | {WINDOW}):
                    literals = np.concatenate([[0], np.cumsum(tokens.literal)])
                    hashes = run_hashes(tokens.hashes, size)
                    place = np.arange(len(hashes))
                    text = np.searchsorted(tokens.bounds, place, "right") - 1
                    fits = place + size <= tokens.bounds[text + 1]
                    fits &= literals[place + size] - literals[place] >= LITERALS
                    if wanted is not None:
                        fits &= wanted.has(hashes)
                    elif size < WINDOW:
                        fits &= counts[text] == size
                    place, text = place[fits], text[fits]
                    slots = [
                        tokens.fillers[p : p + size][~tokens.literal[p : p + size]].view(np.int64).tolist() for p in place
                    ]
                    all_windows = np.maximum(counts[text] - size + 1, 1)
                    yield window_rows(
                        hashes[place], ids.take(pa.array(text)), place - tokens.bounds[text], all_windows, slots
                    )

    return find


def with_id(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"), "text")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """(doc, item, matched, usable, share, reparameterised) per contaminated document and item.

    ``matched`` of the item's ``usable`` windows stand in the document, all of them if it
    holds the whole item, which is the one window of an item without templates;
    ``reparameterised`` tells that a slot has another value there.
    """
    small_batches(docs.sparkSession)
    items = stage(with_id(benchmark, item_key).mapInArrow(template_windows(None), WINDOWS), "items")
    wanted = bit_set(items, "h", LOG_BITS)
    # As many as the items have different numbers of words.
    item_sizes = [row.n_windows for row in items.filter(F.col("place") == WHOLE).select("n_windows").distinct().collect()]
    documents_windows = template_windows(list(range(LITERALS, WINDOW + 1)), wanted, sorted(item_sizes))
    found = with_id(docs, doc_key).mapInArrow(documents_windows, WINDOWS)
    windows = F.countDistinct(F.when(F.col("place") >= 0, F.col("place")))
    usable = items.groupBy(F.col("id").alias("own")).agg(F.greatest(windows, F.lit(1)).alias("usable"))
    items = items.filter(F.col("place") != ANCHOR).select("h", F.col("id").alias("item"), F.col("place").alias("item_place"), F.col("slots").alias("item_slots"))
    met = found.select("h", F.col("id").alias("doc"), "place", "slots").join(items, "h")
    met = met.filter(F.size("slots") == F.size("item_slots"))
    pairs = F.arrays_zip(F.col("item_slots").alias("asked"), F.col("slots").alias("given"))
    # A whole item is an alignment of its own.
    shift = F.when(F.col("item_place") >= 0, F.col("place") - F.col("item_place"))
    aligned = met.groupBy("doc", "item", shift.alias("shift")).agg(
        F.collect_set("item_place").alias("places"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs")
    )
    # Bounded by the item: an alignment has each of its windows once.
    asked = F.array_distinct(F.transform("pairs", lambda pair: pair["asked"]))
    aligned = aligned.filter(F.size("pairs") == F.size(asked))
    other = F.exists("pairs", lambda pair: pair["asked"] != pair["given"])
    copied = F.array_contains("places", WHOLE)
    places = F.when(~copied, F.col("places"))
    whole = aligned.withColumns({"other": other, "copied": copied, "places": places}).groupBy("doc", "item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).alias("matched"),
        F.max("other").alias("reparameterised"),
        F.max("copied").alias("copied"),
    )
    result = whole.join(usable, F.col("item").eqNullSafe(F.col("own")))
    result = result.withColumn("matched", F.when(F.col("copied"), F.col("usable")).otherwise(F.col("matched")))
    result = result.filter(F.col("matched") >= F.least(F.lit(NEEDED), F.col("usable")))
    return result.select(
        F.col("doc").alias(doc_key),
        F.col("item").alias(item_key),
        F.col("matched").cast("long").alias("matched"),
        F.col("usable").cast("long").alias("usable"),
        (F.col("matched") / F.col("usable")).alias("share"),
        "reparameterised",
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` that no benchmark item contaminates.

    Every row is judged by its own text, also where ids are missing or repeated. Only rows
    that may be contaminated meet the list of those that are; all others pass by without a
    shuffle.
    """
    # In a struct no column of the input can clash with the key.
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_whole")
    keyed = docs.select(row_key().alias("_row"), F.col("text").alias("text"), whole)
    leaked = stage(contamination(keyed, benchmark, "_row").select("_row").distinct(), "leaked")
    return docs_without(keyed.select("_row", "_whole"), leaked, "_row").select("_whole.*")
