"""Toxicity: a support vector machine over a gapped subsequence kernel, with Nyström landmarks.

A sentence is read as letter groups: the letters of a token between blanks (so "i-d.i0t"
is "idit"), where neighbouring tokens of a single letter are one group ("i d i o t"). It is
a bag of spans, every run of one to ``PHRASE`` groups in it, with a mark between groups
as one more symbol. The kernel of two spans is the cosine-like product of their gapped
subsequences: every four symbols in order within ``SPAN`` places weigh ``DECAY`` to the
number of symbols skipped, so left-out and inserted letters cost a factor, not the match,
and a phrase of ordinary words has subsequences across its blanks that the words have not.

Learning takes the sentences of a bounded sample of labelled documents. A sentence has its
document's label, but only some span of it is the reason: the witnesses of toxic sentences
are the shortest spans that occur mostly in toxic documents, beyond chance; spans that few
toxic documents hold are clean. Of equal sentences only one document's count, so neither
copies nor a long document make an insult of a rare word. The machine is trained on kernel values
against landmark spans of both kinds, whitened by the landmarks' own kernel matrix, and
again, ``ROUNDS`` times, with the clean spans that it took for insults.
Such a machine is linear in the subsequences of its landmarks, so its decision for a
span is a sum of one weight per subsequence: scoring looks weights up in one table of
fixed size, whatever the number of landmarks, and running sums over a text give the
decision of every span. A sentence has the decision of its worst span, a document that of
its worst sentence, and a logistic curve fitted on the sample turns it into a probability.

Null and empty texts, and texts without letters, have the score of a text without any
insult. Without labels, or without any insult found, every score is the share of toxic
documents in the sample (0 without labels). Extra columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.learning import HELD_OUT, bounded_sample, code_points, fold, is_held_out, letters
from tillroll.llm.text import NOT_BLANK, ROOT, ROOT_INVERSE, mix, pieces, powers
from tillroll.staging import stage

#: Learning takes about this many labelled documents of each class at most.
DOCS_PER_CLASS = 6000
LANDMARKS = 192
CLEAN_EXAMPLES = 2500
#: Longest span of a sentence, in letter groups.
PHRASE = 3
#: Trainings with the clean spans that the one before took for insults.
ROUNDS = 2
#: A span is an insult example from this share of toxic documents on, with so large a
#: logarithm of the likelihood ratio against the share of toxic documents at large.
TOXIC_SHARE = 0.5
LEAST_EVIDENCE = 8.0
CLEAN_SHARE = 0.3
#: Spans that are looked through for the shortest insults.
WITNESSES = 8000
PREDICT_FROM = 0.3

SPAN = 6
DECAY = 0.5
#: Longer groups are read in overlapping parts, so that an insult inside is not diluted.
LONGEST = 24
ALPHABET = 32
LETTERS = 4
FEATURES = ALPHABET**LETTERS
#: Places of the second to last letter of a subsequence after its first.
PATTERNS = list(combinations(range(1, SPAN), LETTERS - 1))
REGULARISATION = 1e-3
STOPS = [ord(mark) for mark in ".!?"]
SENTENCE_END = r"(?<=[.!?])[\t\x0B\f\r ]+|\n"


@dataclass
class Groups:
    """Letter groups, or spans of them: symbols with a mark between groups, and ranges.

    ``start`` and ``stop`` delimit the symbols of a group with both end marks; ``text`` is
    the number of its text, ``sentence`` that of its sentence among those of all texts,
    ``at`` the place of its first letter in that text.
    """

    symbols: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    text: np.ndarray
    sentence: np.ndarray
    at: np.ndarray

    def word(self, group: int) -> bytes:
        return self.symbols[self.start[group] : self.stop[group]].tobytes()


def symbol_of(points: np.ndarray) -> np.ndarray:
    """1..26 for a-z, 27..31 by hash for other letters; 0 marks the end of a group."""
    plain = (points >= ord("a")) & (points <= ord("z"))
    other = 27 + (mix(points.astype(np.uint64)) % np.uint64(ALPHABET - 27)).astype(np.int64)
    return np.where(plain, points.astype(np.int64) - ord("a") + 1, other)


def letter_groups(texts: list[str]) -> Groups:
    points, bounds = code_points(texts)
    is_letter = letters()[points] == 1
    blank = (points < 256) & ~NOT_BLANK[np.minimum(points, 255)]
    token = np.cumsum(blank)  # blanks, and with them ends of texts, start a new token
    at = np.flatnonzero(is_letter)
    if not len(at):
        none = np.empty(0, np.int64)
        return Groups(np.zeros(1, np.uint8), none, none, none, none, none)
    of = token[at]
    first = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
    size = np.diff(np.append(first, len(at)))
    text = np.searchsorted(bounds, at[first], "right") - 1
    # A single letter joins the token before it, if that is a single letter of the same text.
    joins = np.concatenate([[False], (size[1:] == 1) & (size[:-1] == 1) & (text[1:] == text[:-1]) & (np.diff(of[first]) == 1)])
    first, text = first[~joins], text[~joins]
    # One end mark before each group and one after the last.
    symbols = np.zeros(len(at) + len(first) + 1, np.uint8)
    number = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(at))))
    symbols[np.arange(len(at)) + number + 1] = symbol_of(points[at])
    start = first + np.arange(len(first))
    stop = np.append(start[1:], len(symbols) - 1) + 1
    # A sentence ends with its line, its text, or a mark before a blank.
    ends = (points == ord("\n")) | (np.isin(points, STOPS) & np.append(blank[1:], True))
    sentence = np.cumsum(ends)[at[first]]
    groups = Groups(symbols, start, stop, text, sentence, at[first] - bounds[text])
    return parted(groups) if (stop - start > LONGEST + 2).any() else groups


def parted(groups: Groups) -> Groups:
    """Long groups as overlapping parts; short ones unchanged."""
    size = groups.stop - groups.start
    half = LONGEST // 2
    parts = np.where(size > LONGEST + 2, -(-(size - LONGEST - 2) // half) + 1, 1)
    number = np.repeat(np.arange(len(size)), parts)
    step = np.arange(len(number)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = groups.start[number] + half * step
    stop = np.where(step + 1 < parts[number], start + LONGEST + 2, groups.stop[number])
    return Groups(groups.symbols, start, stop, groups.text[number], groups.sentence[number], groups.at[number] + half * step)


def spans(groups: Groups) -> Groups:
    """Every run of up to ``PHRASE`` groups within a sentence, by its first group."""
    n = len(groups.start)
    last = np.arange(n)[:, None] + np.arange(PHRASE)
    inside = last < n
    last = np.minimum(last, max(n - 1, 0))
    inside &= (groups.sentence[last] == groups.sentence[:, None]) & (groups.text[last] == groups.text[:, None])
    first = np.nonzero(inside)[0]
    return Groups(
        groups.symbols,
        groups.start[first],
        groups.stop[last[inside]],
        groups.text[first],
        groups.sentence[first],
        groups.at[first],
    )


def unique_groups(groups: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Index of one group per distinct content, and for every group the number of its content."""
    n = len(groups.symbols)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((groups.symbols.astype(np.uint64) + np.uint64(1)) * powers(ROOT, n), out=sums[1:])
    hashes = (sums[groups.stop] - sums[groups.start]) * powers(ROOT_INVERSE, n)[groups.start]
    _, index, number = np.unique(mix(hashes), return_index=True, return_inverse=True)
    return index, number


def subsequences(symbols: np.ndarray, start: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(group, feature, weight) of all gapped subsequences of the groups, by gap pattern."""
    size = stop - start
    number = np.repeat(np.arange(len(size)), size)
    place = np.arange(len(number)) - np.repeat(np.cumsum(size) - size, size)
    own = symbols[start[number] + place].astype(np.int64)
    left = size[number] - place
    for places in PATTERNS:
        at = np.flatnonzero(left > places[-1])
        feature = own[at]
        for place in places:
            feature = feature * ALPHABET + own[at + place]
        yield number[at], feature, skip_weight(places)


def skip_weight(places: tuple[int, ...]) -> float:
    return DECAY ** (places[-1] - len(places))


def norms(size: np.ndarray) -> np.ndarray:
    """Length of a group's subsequence vector if none occurs twice; depends on the size only."""
    squares = sum(np.maximum(size - places[-1], 0) * skip_weight(places) ** 2 for places in PATTERNS)
    return np.sqrt(np.maximum(squares, 1.0))


@dataclass
class ToxicityModel:
    """Weight per subsequence, bias, the two parameters of the logistic curve and the base share."""

    weights: np.ndarray | None
    bias: float
    slope: float
    offset: float
    base: float

    def chance(self, decision: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(decision), self.base)
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.offset, -30, 30)))


def decisions(model: ToxicityModel, groups: Groups) -> np.ndarray:
    """Decision of the machine per group or span, by running sums over all symbols."""
    own = groups.symbols.astype(np.int32)
    size = groups.stop - groups.start
    total = np.zeros(len(size))
    for reach in range(LETTERS - 1, SPAN):
        n = max(len(own) - reach, 0)
        at = np.zeros(len(own))
        for places in PATTERNS:
            if places[-1] != reach:
                continue
            feature = own[:n]
            for place in places:
                feature = feature * ALPHABET + own[place : place + n]
            at[:n] += skip_weight(places) * model.weights[feature]
        sums = np.concatenate([[0.0], np.cumsum(at)])
        total += sums[np.maximum(groups.stop - reach, groups.start)] - sums[groups.start]
    # Rounded, so that it does not depend on the texts that share a batch.
    return np.round(total / norms(size) + model.bias, 6)


def group_rows(words: list[bytes]) -> Groups:
    size = np.array([len(word) for word in words], np.int64)
    stop = np.cumsum(size)
    none = np.zeros(len(words), np.int64)
    return Groups(np.frombuffer(b"".join(words), np.uint8), stop - size, stop, none, none, none)


def vectors(words: list[bytes], column_of: np.ndarray, columns: int) -> np.ndarray:
    """Normalised subsequence vectors, on the columns that ``column_of`` knows."""
    groups = group_rows(words)
    out = np.zeros((len(words), columns + 1), np.float32)
    for group, feature, weight in subsequences(groups.symbols, groups.start, groups.stop):
        np.add.at(out, (group, column_of[feature]), weight)
    return out[:, :columns] / norms(groups.stop - groups.start)[:, None].astype(np.float32)


def fit_machine(toxic: list[tuple[bytes, float]], clean: list[tuple[bytes, float]]) -> tuple[np.ndarray, float]:
    """(weight per subsequence, bias) from (group, number of documents) examples."""
    landmarks = [word for word, _ in toxic[: LANDMARKS * 2 // 3]]
    landmarks += [word for word, _ in clean[: LANDMARKS - len(landmarks)]]
    groups = group_rows(landmarks)
    used = np.unique(np.concatenate([feature for _, feature, _ in subsequences(groups.symbols, groups.start, groups.stop)]))
    column_of = np.full(FEATURES, len(used))
    column_of[used] = np.arange(len(used))
    marks = vectors(landmarks, column_of, len(used))

    values, axes = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    whiten = axes[:, keep] / np.sqrt(values[keep])
    words = [word for word, _ in [*toxic, *clean]]
    kernel = np.concatenate([vectors(words[i : i + 500], column_of, len(used)) @ marks.T for i in range(0, len(words), 500)])
    x = np.column_stack([kernel @ whiten, np.ones(len(words))])
    y = np.repeat([1.0, -1.0], [len(toxic), len(clean)])
    documents = np.sqrt([n for _, n in [*toxic, *clean]])
    each = np.concatenate([part / part.sum() for part in np.split(documents, [len(toxic)])])

    ridge = np.diag([REGULARISATION] * (x.shape[1] - 1) + [0.0])
    machine = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of the squared hinge loss
        active = y * (x @ machine) < 1
        weighted = x[active] * each[active][:, None]
        step = np.linalg.solve(weighted.T @ x[active] + ridge + 1e-9 * np.eye(len(ridge)), weighted.T @ y[active])
        if np.allclose(step, machine, atol=1e-7):
            break
        machine = step
    weights = np.zeros(FEATURES, np.float32)
    weights[used] = marks.T @ (whiten @ machine[:-1])
    return weights, float(machine[-1])


def fit_curve(decision: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton steps on weighted labels."""
    x = np.column_stack([decision, np.ones(len(decision))])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (weight * (p - toxic)) + 1e-3 * at
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        at = at - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(at[0], 0.0)), float(at[1])


def learn(labelled: DataFrame, docs_per_class: int = DOCS_PER_CLASS) -> ToxicityModel:
    """Model of the rows (key, text, toxic), toxic being 0 or 1; other rows teach nothing."""
    known = labelled.filter("toxic IN (0, 1) AND text IS NOT NULL").select("key", "text", "toxic")
    return learn_from_sample(*bounded_sample(known, "toxic", "key", docs_per_class))


def learn_from_sample(sample: DataFrame, shares: dict[int, float]) -> ToxicityModel:
    """Model of sampled rows (key, text, toxic) that are a known share of each class."""
    sample = stage(sample, "labelled")
    scale = {value: 1 / share for value, share in shares.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                groups = spans(letter_groups([text.lower() for text in piece.column("text").to_pylist()]))
                if not len(groups.start):
                    continue
                index, number = unique_groups(groups)
                held, text = np.divmod(np.unique(number * piece.num_rows + groups.text), piece.num_rows)
                label = np.array(piece.column("toxic").to_pylist())[text]
                n = len(index)
                yield pa.record_batch(
                    [
                        pa.array([groups.word(i) for i in index], pa.binary()),
                        pa.array(np.bincount(held, label == 1, n)),
                        pa.array(np.bincount(held, label == 0, n)),
                    ],
                    ["word", "toxic", "clean"],
                )

    per_label = {row[0]: row[1] for row in sample.groupBy("toxic").count().collect()}
    whole = {value: n * scale[value] for value, n in per_label.items()}
    model = ToxicityModel(None, 0.0, 1.0, 0.0, whole.get(1, 0.0) / max(sum(whole.values()), 1.0))
    if not 0 < model.base < 1:
        return model

    # Of equal sentences, as copied documents have them, one document keeps its; a clean one first.
    every = sample.select("toxic", "key", F.explode(F.split("text", SENTENCE_END)).alias("sentence"))
    first = every.groupBy("sentence").agg(F.min(F.struct("toxic", "key")).alias("of")).select("of.*", "sentence")
    own = first.groupBy("key", "toxic").agg(F.concat_ws("\n", F.collect_list("sentence")).alias("text"))
    own = stage(own, "sentences")
    per_label = {row[0]: row[1] for row in own.groupBy("toxic").count().collect()}
    if len(per_label) < 2:
        return model
    counted = own.select("text", "toxic").mapInArrow(count, "word binary, toxic double, clean double")
    counted = counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = F.col("toxic") * scale[1] / (F.col("toxic") * scale[1] + F.col("clean") * scale[0])
    at_large = per_label[1] / (per_label[1] + per_label[0])
    part = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    evidence = F.col("toxic") * F.log(part / at_large) + F.col("clean") * F.log(F.greatest(1 - part, F.lit(1e-9)) / (1 - at_large))
    counted = stage(counted.select("word", "toxic", "clean", share.alias("share"), evidence.alias("evidence")), "groups")
    # Bounded by the number of examples that one machine is trained on.
    toxic = counted.filter((F.col("share") >= TOXIC_SHARE) & (F.col("evidence") >= LEAST_EVIDENCE))
    # A part of a span is in no fewer documents, so it comes before the span.
    toxic = toxic.orderBy(F.desc("toxic"), F.length("word"), "word").limit(WITNESSES).collect()
    clean = counted.filter((F.col("share") < CLEAN_SHARE) & (F.col("clean") > 0)).select("word", "clean")
    frequent = clean.orderBy(F.desc("clean"), "word").limit(CLEAN_EXAMPLES // 2).collect()
    others = clean.orderBy(F.xxhash64("word"), "word").limit(CLEAN_EXAMPLES // 2).collect()
    if not toxic or not frequent:
        return model
    insults = shortest([(bytes(row["word"]), float(row["toxic"])) for row in toxic])[: 4 * LANDMARKS]
    examples = {bytes(row["word"]): float(row["clean"]) for row in [*frequent, *others]}

    def fit() -> None:
        ordered = sorted(examples.items(), key=lambda example: (-example[1], example[0]))
        model.weights, model.bias = fit_machine(insults, ordered)

    def mistaken(machine):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = decisions(machine.value, group_rows(batch.column("word").to_pylist()))
                yield pa.record_batch([batch.column("word"), batch.column("clean"), pa.array(found)], ["word", "clean", "decision"])

        return find

    fit()
    for _ in range(ROUNDS):
        taken = clean.mapInArrow(mistaken(docs_broadcast(sample, model)), "word binary, clean double, decision double")
        hardest = taken.orderBy(F.desc("decision"), "word").limit(CLEAN_EXAMPLES // 2).collect()
        examples |= {bytes(row["word"]): float(row["clean"]) for row in hardest}
        fit()

    # Decisions of the sample, counted in steps of a hundredth, fit the curve.
    scored = decided(sample, model, ["toxic"])
    steps = scored.groupBy("toxic", F.round("decision", 2).alias("decision")).count().collect()
    model.slope, model.offset = fit_curve(
        np.array([row["decision"] for row in steps]),
        np.array([float(row["toxic"]) for row in steps]),
        np.array([row["count"] * scale[row["toxic"]] for row in steps]),
    )
    return model


def shortest(found: list[tuple[bytes, float]]) -> list[tuple[bytes, float]]:
    """The spans that hold no span listed before them."""
    kept: dict[bytes, float] = {}
    for word, documents in found:
        groups = word[1:-1].split(b"\0")
        parts = [b"\0".join(groups[i:j]) for i in range(len(groups)) for j in range(i + 1, len(groups) + 1)]
        if not any(b"\0" + part + b"\0" in kept for part in parts):
            kept[word] = documents
    return list(kept.items())


def docs_broadcast(df: DataFrame, model: ToxicityModel):
    """The model in every executor: one table of fixed size."""
    return df.sparkSession.sparkContext.broadcast(model)


#: Decision of a text without any letter group.
NOTHING = -2.0


def decided(docs: DataFrame, model: ToxicityModel, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every row with the decision and the sentence of its worst group."""
    shared_model = docs_broadcast(docs, model)
    rows = docs.select(*columns, F.col(text).alias("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema.fields)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model.value
        for batch in batches:
            for piece in pieces(batch):
                raw = piece.column("text").to_pylist()
                texts = [text.lower() for text in raw]
                worst, sentences = np.full(len(texts), NOTHING), [None] * len(texts)
                if model.weights is not None:
                    groups = spans(letter_groups(texts))
                    found = np.maximum(decisions(model, groups), NOTHING)
                    # Spans are in the order of their texts.
                    own, start = np.unique(groups.text, return_index=True)
                    if len(own):
                        worst[own] = np.maximum.reduceat(found, start)
                    is_worst = np.flatnonzero(found == worst[groups.text])
                    first = is_worst[np.unique(groups.text[is_worst], return_index=True)[1]]
                    for group in first:
                        i = groups.text[group]
                        same = len(raw[i]) == len(texts[i])
                        sentences[i] = sentence_at(raw[i] if same else texts[i], int(groups.at[group]))
                yield pa.record_batch(
                    [
                        *[piece.column(name) for name in columns],
                        pa.array(worst),
                        pa.array(sentences, pa.string()),
                    ],
                    [*columns, "decision", "sentence"],
                )

    return rows.mapInArrow(decide, f"{schema}, decision double, sentence string")


def sentence_at(text: str, at: int) -> str:
    start = max(text.rfind(mark, 0, at) for mark in ".!?\n") + 1
    ends = [end for end in (text.find(mark, at) for mark in ".!?\n") if end >= 0]
    return text[start : min(ends, default=len(text))].strip()


def score(docs: DataFrame, model: ToxicityModel, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every row with score, predicted and the worst sentence if predicted."""
    slope, offset, base = model.slope, model.offset, model.base
    chance = F.lit(base) if model.weights is None else 1 / (1 + F.exp(-(F.lit(slope) * F.col("decision") + F.lit(offset))))
    scored = decided(docs, model, columns, text).withColumn("score", chance)
    toxic = F.col("score") >= PREDICT_FROM
    return scored.select(*columns, "score", toxic.cast("int").alias("predicted"), F.when(toxic, F.col("sentence")).alias("sentence"))


def learn_from_labels(docs: DataFrame, labels: DataFrame, docs_per_class: int = DOCS_PER_CLASS) -> ToxicityModel:
    """Model of the labelled documents outside the held-out fold.

    A document with several labels is toxic if one of them is. Labels are sampled before
    they meet the texts: no more than about two ``docs_per_class`` ids and their texts do.
    """
    labels = labels.filter(fold() != HELD_OUT).filter("toxic IN (0, 1)")
    labels = stage(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labels")
    sample, shares = bounded_sample(labels, "toxic", "doc_id", docs_per_class)
    # The sample has a bound, so it can be sent to the texts.
    met = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(sample), "doc_id")
    return learn_from_sample(met.select(F.col("doc_id").alias("key"), "text", "toxic"), shares)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, sentence) of every row of ``docs``."""
    model = learn_from_labels(docs, labels)
    return score(docs, model, ["doc_id"]).select("doc_id", is_held_out().alias("held_out"), "score", "predicted", "sentence")
