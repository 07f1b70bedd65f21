"""Language identification of mixed text: scripts, per-word scores, Viterbi.

A word is a run of letters and marks. The script of its first letter narrows the
languages to those seen in that script while learning; each of these scores the word by
the log-likelihoods of its character bigrams and trigrams (with word ends), and a Viterbi
path with a penalty for every change of language labels the words. Consecutive words of a
language are a span. A text's language is the one with the most letters on the path, ties
by name; its score is the share of those letters times the odds against the next language.

Learning counts n-grams in a sample of at most about ``DOCS_PER_LANGUAGE`` labelled
documents per language, chosen by a hash of the id; a model has one fixed-size table per
language. A script that no learned language has for ``SCRIPT_SHARE`` of its words narrows
nothing: its words decide nothing beside others, and in a text without others all languages
compete by their n-grams, ties by name, for a score of at most one over their number.
Null texts, and texts without a letter, are ``und`` with score 0 and no spans; so is every
text if there is nothing to learn from. The stage of the pipeline (``keep_identified``)
drops the texts without a letter and puts the predicted language of the others into ``lang``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import small_batches
from tillroll.llm.learning import HELD_OUT, bounded_sample, code_points, fold, is_held_out, letters
from tillroll.llm.text import mix, pieces, runs
from tillroll.llm.vectors import add_up, packed

DOCS_PER_LANGUAGE = 3000
#: Log-likelihood that one change of language costs.
SWITCH_PENALTY = 12.0
#: A language may have a script that holds this share of its words.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"

TABLE = 1 << 16
SMOOTHING = 0.5

# First code point of a range and the script of its letters up to the next.
SCRIPTS = [
    (0x0000, "Latin"),
    (0x0370, "Greek"),
    (0x0400, "Cyrillic"),
    (0x0530, "Armenian"),
    (0x0590, "Hebrew"),
    (0x0600, "Arabic"),
    (0x0900, "Devanagari"),
    (0x0980, "Bengali"),
    (0x0A00, "Gurmukhi"),
    (0x0A80, "Gujarati"),
    (0x0B00, "Oriya"),
    (0x0B80, "Tamil"),
    (0x0C00, "Telugu"),
    (0x0C80, "Kannada"),
    (0x0D00, "Malayalam"),
    (0x0D80, "Sinhala"),
    (0x0E00, "Thai"),
    (0x0E80, "Lao"),
    (0x0F00, "Tibetan"),
    (0x1000, "Myanmar"),
    (0x10A0, "Georgian"),
    (0x1100, "Hangul"),
    (0x1200, "Ethiopic"),
    (0x1400, "Other"),
    (0x1780, "Khmer"),
    (0x1800, "Mongolian"),
    (0x1E00, "Latin"),
    (0x1F00, "Greek"),
    (0x2000, "Other"),
    (0x3040, "Kana"),
    (0x3100, "Han"),
    (0xAC00, "Hangul"),
    (0xD7B0, "Other"),
    (0xF900, "Han"),
    (0xFB00, "Other"),
    (0xFF21, "Latin"),
    (0xFF66, "Kana"),
    (0xFFA0, "Other"),
    (0x20000, "Han"),
    (0x323B0, "Other"),
]
SCRIPT_STARTS = np.array([start for start, _ in SCRIPTS])
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
SCRIPT_IDS = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


@dataclass
class LanguageModel:
    """Languages in order of name, log-likelihoods per n-gram cell, allowed scripts."""

    languages: list[str]
    scores: np.ndarray
    allowed: np.ndarray


@dataclass
class WordGrams:
    """Words of several lowered texts: code point ranges, scripts, texts' word ranges, n-gram cells."""

    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    bounds: np.ndarray
    bigrams: np.ndarray
    trigrams: np.ndarray
    first_gram: np.ndarray


def word_grams(texts: list[str]) -> WordGrams:
    points, bounds = code_points(texts)
    kind = letters()[points]
    start, end = runs(kind > 0)
    # Words start at a letter: marks before it, or without one, are in no word.
    is_letter = np.append(np.flatnonzero(kind == 1), len(kind))
    start = is_letter[np.searchsorted(is_letter, start)]
    start, end = start[start < end], end[start < end]
    inside = np.zeros(len(kind) + 1, np.int8)
    inside[start], inside[end] = 1, -1
    inside = np.cumsum(inside[:-1]) > 0
    here = np.where(inside, points, 0).astype(np.uint64)
    one_back = np.concatenate([[0], here[:-1]]).astype(np.uint64)
    two_back = np.where(one_back > 0, np.concatenate([[0, 0], here[:-2]])[: len(here)], 0).astype(np.uint64)
    # One gram ends at each character of a word and one at the place after it.
    at = np.flatnonzero(inside | (one_back > 0))
    here, one_back, two_back = here[at], one_back[at], two_back[at]
    pair = one_back * np.uint64(0x110000) + here
    shift = np.uint64(64 - 16)
    bigrams = (mix(pair + np.uint64(1)) >> shift).astype(np.int64)
    trigrams = (mix(mix(pair + np.uint64(2)) + two_back) >> shift).astype(np.int64)
    script = SCRIPT_IDS[np.searchsorted(SCRIPT_STARTS, points[start], "right") - 1]
    return WordGrams(
        start, end, script, np.searchsorted(start, bounds), bigrams, trigrams, np.searchsorted(at, start)
    )


def lowered(piece: pa.RecordBatch) -> list[str]:
    return [text.lower() for text in piece.column("text").to_pylist()]


def learn(labelled: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> LanguageModel:
    """Model of the rows (key, text, lang); null texts and languages teach nothing."""
    small_batches(labelled.sparkSession)
    known = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("key", "text", "lang")
    sample, shares = bounded_sample(known, "lang", "key", docs_per_language)
    languages = sorted(shares)
    number = {name: i for i, name in enumerate(languages)}
    cells = 2 * TABLE + len(SCRIPT_NAMES)
    if not languages:
        return LanguageModel([], np.zeros((2 * TABLE, 0), np.float32), np.zeros((len(SCRIPT_NAMES), 0), bool))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), cells), np.int64)
        for batch in batches:
            for piece in pieces(batch):
                grams = word_grams(lowered(piece))
                own = np.array([number[name] for name in piece.column("lang").to_pylist()])
                of_word = np.repeat(own, np.diff(grams.bounds))
                of_gram = np.repeat(of_word, np.diff(np.append(grams.first_gram, len(grams.bigrams))))
                np.add.at(total, (of_gram, grams.bigrams), 1)
                np.add.at(total, (of_gram, grams.trigrams + TABLE), 1)
                np.add.at(total, (of_word, grams.script + 2 * TABLE), 1)
        yield pa.record_batch([pa.array([packed(total)], pa.binary())], ["counts"])

    counted = add_up(sample.select("text", "lang").mapInArrow(count, "counts binary"), "counts", len(languages) * cells, np.int64)
    counted = counted.reshape(len(languages), cells).T
    tables = [counted[:TABLE], counted[TABLE : 2 * TABLE]]
    scores = [np.log((t + SMOOTHING) / (t.sum(axis=0) + SMOOTHING * TABLE)) for t in tables]
    scripts = counted[2 * TABLE :]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    return LanguageModel(languages, np.concatenate(scores).astype(np.float32), allowed)


def word_scores(model: LanguageModel, grams: WordGrams, decides: np.ndarray) -> np.ndarray:
    """Log-likelihood per word and language; words that do not decide have 0 for all."""
    if not len(grams.start):
        return np.zeros((0, len(model.languages)), np.float32)
    each = model.scores[grams.bigrams] + model.scores[grams.trigrams + TABLE]
    scores = np.add.reduceat(each, grams.first_gram, axis=0)
    allowed = model.allowed[grams.script]
    allowed |= ~allowed.any(axis=1, keepdims=True)
    scores = np.where(allowed, scores, scores.min(axis=1, keepdims=True) - 3 * SWITCH_PENALTY)
    scores[~decides] = 0
    return scores


def viterbi(scores: np.ndarray, bounds: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Best language of every word; all texts advance together, the longest first."""
    counts = np.diff(bounds)
    order = np.argsort(-counts, kind="stable")
    first, counts = bounds[:-1][order], counts[order]
    stays = np.ones(scores.shape, bool)
    leader = np.zeros(len(scores), np.int64)
    path = np.zeros(len(scores), np.int64)
    longest = int(counts[0]) if len(counts) else 0
    active = np.searchsorted(-counts, -np.arange(longest), "left")  # texts with more than t words
    value = scores[first[: active[0]]] if longest else None
    for t in range(1, longest):
        n = active[t]
        ended = slice(n, active[t - 1])
        path[first[ended] + t - 1] = value[ended].argmax(axis=1)
        value = value[:n]
        at = first[:n] + t
        top = value.argmax(axis=1)
        moved = value[np.arange(n), top][:, None] - penalty
        stays[at] = value >= moved
        leader[at] = top
        value = np.maximum(value, moved) + scores[at]
    if longest:
        path[first[: active[-1]] + longest - 1] = value.argmax(axis=1)
    for t in range(longest - 1, 0, -1):
        at = first[: active[t]] + t
        here = path[at]
        path[at - 1] = np.where(stays[at, here], here, leader[at])
    return path


SPANS = "array<struct<start: long, stop: long, lang: string>>"
PREDICTED = f"lang_pred string, score double, spans {SPANS}"


def predict(docs: DataFrame, model: LanguageModel, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every row with lang_pred, score and spans.

    Spans are code point ranges of the text, from the first to past the last letter of
    consecutive words of one language.
    """
    context = docs.sparkSession.sparkContext
    shared_model = context.broadcast(model)  # one fixed-size table per language
    rows = docs.select(*columns, F.col(text).alias("text"))
    kept = [field for field in rows.schema.fields if field.name in columns]
    schema = rows.select(*columns).schema
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields) + ", " + PREDICTED
    names = [f.name for f in kept]

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        for batch in batches:
            for piece in pieces(batch):
                found = labelled_texts(model, lowered(piece))
                yield pa.record_batch(
                    [
                        *[piece.column(name) for name in names],
                        pa.array([x[0] for x in found], pa.string()),
                        pa.array([x[1] for x in found], pa.float64()),
                        pa.array([x[2] for x in found], ARROW_SPANS),
                    ],
                    [*names, "lang_pred", "score", "spans"],
                )

    return rows.mapInArrow(label, out_schema)


ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())]))


def labelled_texts(model: LanguageModel, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
    grams = word_grams(texts)
    if not model.languages:
        return [(UNKNOWN, 0.0, []) for _ in texts]
    known = model.allowed[grams.script].any(axis=1)
    # Scripts that no language knows are no evidence, unless a text has nothing else.
    counts = np.diff(grams.bounds)
    known_words = np.diff(np.append(0, np.cumsum(known))[grams.bounds])
    scores = word_scores(model, grams, known | np.repeat(known_words == 0, counts))
    path = viterbi(scores, grams.bounds)
    lengths = grams.end - grams.start
    text_starts = np.concatenate([[0], np.cumsum([len(text) + 1 for text in texts])])
    out = []
    for i, (first, last) in enumerate(zip(grams.bounds[:-1], grams.bounds[1:])):
        if first == last:
            out.append((UNKNOWN, 0.0, []))
            continue
        own, size = path[first:last], lengths[first:last]
        share = np.bincount(own, size, len(model.languages))
        best = int(share.argmax())
        evidence = scores[first:last][own == best].sum(axis=0)
        ahead = evidence[best] - np.delete(evidence, best).max() if len(evidence) > 1 else 50.0
        odds = 1 / (1 + np.exp(-np.clip(ahead, -50, 50)))
        cuts = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [last - first]])
        spans = [
            {
                "start": int(grams.start[first + a] - text_starts[i]),
                "stop": int(grams.end[first + b - 1] - text_starts[i]),
                "lang": model.languages[own[a]],
            }
            for a, b in zip(cuts[:-1], cuts[1:])
        ]
        most = 1.0 if known_words[i] else 1.0 / len(model.languages)
        out.append((model.languages[best], float(most * share[best] / size.sum() * odds), spans))
    return out


def learn_from_documents(docs: DataFrame) -> LanguageModel:
    """Model of the documents outside the held-out fold."""
    return learn(docs.filter(fold() != HELD_OUT).select(F.col("doc_id").alias("key"), "text", "lang"))


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_spans) of every row of ``docs``."""
    labelled = predict(docs, learn_from_documents(docs), ["doc_id"])
    return labelled.select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def has_letter(text: str) -> bool:
    return bool((letters()[code_points([text])[0]] == 1).any())


def keep_identified(docs: DataFrame) -> DataFrame:
    """``documents`` with a letter, and their predicted language as ``lang``.

    Null texts and texts without any letter go. If there was nothing to learn from, ``lang``
    stays as it is. Only the texts go to Python; the rows stay in the JVM.
    """
    small_batches(docs.sparkSession)
    model = learn_from_documents(docs)
    shared_model = docs.sparkSession.sparkContext.broadcast(model)  # one fixed-size table per language

    @F.arrow_udf("string")
    def language_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found: list[str | None] = []
            for piece in pieces(pa.record_batch([texts], ["text"])):
                own = lowered(piece)
                labels = [label for label, _, _ in labelled_texts(shared_model.value, own)]
                # Without a model nothing is predicted for a text with letters.
                found += [None if label == UNKNOWN and has_letter(text) else label for text, label in zip(own, labels)]
            yield pa.array(found, pa.string())

    # Not deterministic to the planner, or it would label each text for the filter and again
    # for the column. In a struct no column of the input can clash with the label.
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_whole")
    predicted = docs.select(whole, language_of.asNondeterministic()("text").alias("_predicted"))
    kept = predicted.filter(F.coalesce(F.col("_predicted") != UNKNOWN, F.lit(True)))
    own = {name: F.col(f"_whole.`{name}`") for name in docs.columns}
    if "lang" in own:
        own["lang"] = F.coalesce("_predicted", own["lang"])
    return kept.select(*[column.alias(name) for name, column in own.items()])
