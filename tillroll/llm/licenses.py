"""License scan with ordered signature rules, in Spark's own expressions only.

Words are runs of a-z, digits and characters beyond ASCII, after lower-casing A-Z. A text
is normalised to its words, each after one blank, and only texts that hold a gate (one of
the parts that the rules need) go on. A rule runs if one of its keywords is a word of the
text. Its matches are intervals of words. An interval is suppressed if another one of the same or a
more explicit priority contains it; of equal intervals the first in the order of
priority and label stays. What is left gives the labels, and the largest confidence of
its rules is the score.

The intervals are sorted by start and falling end, so one pass with the farthest end per
priority finds the suppressed ones. Everything happens within the row: there is no
shuffle, and a hot phrase or source is no hot spot. Null texts are empty, and empty texts
have no label and score 0. Words of a text are counted once per rule, and intervals are put
together in blocks, so a text with very many matches takes time in proportion to them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.license_rules import FORMS, GATES, rules

# Phrases and their labels.
PHRASES = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PRIORITIES = sorted({priority for priority, _, _ in FORMS})
#: Intervals that are put together at a time.
BLOCK = 128
INTERVAL = "struct<start: int, left: int, priority: int, label: string, confidence: double>"


def words_in(part: Column) -> Column:
    """Words of a normalised part, where a blank stands before every word."""
    return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))


def all_rules() -> Column:
    """The rules as an array of (keywords, rules), folded to a constant by the optimizer."""
    return F.array(
        *[
            F.struct(
                F.array(*[F.lit(f" {keyword} ") for keyword in keywords]).alias("keywords"),
                F.array(
                    *[
                        F.struct(
                            F.lit(priority).alias("priority"),
                            F.lit(confidence).alias("confidence"),
                            F.lit(label).alias("label"),
                            F.lit(f" (?:{expression})(?= )").alias("expression"),
                        )
                        for priority, confidence, label, expression in group
                    ]
                ).alias("rules"),
            )
            for keywords, group in rules()
        ]
    )


def intervals_of(text: Column, rule: Column) -> Column:
    """Intervals of words that a rule matches in a normalised text.

    ``left`` is minus the end, so that sorting puts the longer of two intervals first.
    """
    between = F.split(text, rule["expression"], -1)
    matched = F.regexp_extract_all(text, rule["expression"], F.lit(0))
    counts = F.zip_with(between, matched, lambda part, match: F.struct(words_in(part).alias("before"), words_in(match).alias("size")))
    # There is one part more than matches.
    return F.flatten(bound(F.filter(counts, lambda count: count["size"].isNotNull()), lambda own: blocks_of(own, rule)))


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks_of(counts: Column, rule: Column) -> Column:
    """Blocks of ``BLOCK`` intervals, so that no long array grows by one element at a time."""
    interval = F.array().cast(f"array<{INTERVAL}>")
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{INTERVAL}>>").alias("blocks"))
    firsts = F.filter(F.sequence(F.lit(1), F.size(counts) + 1, F.lit(BLOCK)), lambda first: first <= F.size(counts))

    def place(state: Column, count: Column) -> Column:
        begin = state["at"] + count["before"]
        end = begin + count["size"]
        found = F.struct(
            begin.alias("start"),
            (-end).alias("left"),
            rule["priority"].alias("priority"),
            rule["label"].alias("label"),
            rule["confidence"].alias("confidence"),
        )
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(found)).alias("found"))

    def block(state: Column, first: Column) -> Column:
        empty = F.struct(state["at"].alias("at"), interval.alias("found"))
        placed = F.aggregate(F.slice(counts, first, BLOCK), empty, place)
        return bound(
            placed,
            lambda own: F.struct(own["at"].alias("at"), F.concat(state["blocks"], F.array(own["found"])).alias("blocks")),
        )

    return F.aggregate(firsts, start, block, lambda state: state["blocks"])


def kept_labels(intervals: Column) -> Column:
    """(labels, score) of the intervals that no other one contains at its priority or above."""
    start = F.struct(
        *[F.lit(0).alias(f"far{p}") for p in PRIORITIES],
        F.array().cast("array<string>").alias("labels"),
        F.lit(0.0).alias("score"),
    )

    def step(state: Column, interval: Column) -> Column:
        end = -interval["left"]
        contained = reduce(
            lambda a, b: a | b, [(interval["priority"] >= p) & (state[f"far{p}"] >= end) for p in PRIORITIES]
        )
        farther = [
            F.when(interval["priority"] == p, F.greatest(state[f"far{p}"], end)).otherwise(state[f"far{p}"]).alias(f"far{p}")
            for p in PRIORITIES
        ]
        labels = F.when(contained, state["labels"]).otherwise(F.array_union(state["labels"], F.array(interval["label"])))
        score = F.when(contained, state["score"]).otherwise(F.greatest(state["score"], interval["confidence"]))
        return F.struct(*farther, labels.alias("labels"), score.alias("score"))

    return F.aggregate(F.array_sort(intervals), start, step)


def detect(text: Column) -> Column:
    """(labels, score) of a normalised text by all rules."""
    active = F.filter(all_rules(), lambda group: F.exists(group["keywords"], lambda keyword: F.contains(text, keyword)))
    each = F.transform(F.flatten(F.transform(active, lambda group: group["rules"])), lambda rule: intervals_of(text, rule))
    return kept_labels(F.flatten(each))


def phrase_places(text: Column, phrase: str) -> Column:
    """(n, first, last) of the places where a phrase's words stand in a normalised text."""
    size = len(phrase.split())
    between = F.split(text, f" {phrase}(?= )", -1)
    n = F.size(between) - 1
    before_last = F.slice(between, 1, n)
    last = F.aggregate(before_last, F.lit(0), lambda total, part: total + words_in(part)) + (n - 1) * size
    return F.struct(
        n.cast("long").alias("n"),
        F.when(n > 0, words_in(F.get(between, F.lit(0)))).cast("long").alias("first"),
        F.when(n > 0, last).cast("long").alias("last"),
    )


def scan(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every row with words, places of the phrases, labels and score."""
    words = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), NO_WORD, " ")
    spaced = docs.select(*columns, F.translate(F.concat(F.lit(" "), F.trim(words), F.lit(" ")), UPPER, LOWER).alias("words"))
    empty = F.col("words") == "  "
    gates = reduce(lambda a, b: a | b, [F.contains("words", F.lit(gate)) for gate in [*GATES, " cc "]])
    gated = spaced.select(
        *columns,
        F.when(empty, F.lit(0)).otherwise(words_in(F.col("words")) - 1).cast("long").alias("n_words"),
        F.when(gates, F.col("words")).alias("words"),
    )
    found = gated.select(
        *columns,
        "n_words",
        F.when(F.col("words").isNotNull(), F.struct(detect(F.col("words")).alias("rules"), *[
            phrase_places(F.col("words"), phrase).alias(f"phrase{i}") for i, (phrase, _) in enumerate(PHRASES)
        ])).alias("found"),
    )
    places = [F.col(f"found.phrase{i}") for i in range(len(PHRASES))]
    n_base = reduce(lambda a, b: a + b, [F.coalesce(place["n"], F.lit(0)) for place in places])
    base = F.array_compact(F.array(*[F.when(place["n"] > 0, F.lit(label)) for place, (_, label) in zip(places, PHRASES)]))
    by_rules = F.coalesce(F.col("found.rules.labels"), F.array().cast("array<string>"))
    as_text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        *columns,
        "n_words",
        n_base.cast("long").alias("n_base"),
        F.least(*[place["first"] for place in places]).alias("first_word"),
        F.greatest(*[place["last"] for place in places]).alias("last_word"),
        as_text(base).alias("base_labels"),
        as_text(F.concat(base, by_rules)).alias("labels"),
        F.when(n_base > 0, F.lit(1.0)).otherwise(F.coalesce(F.col("found.rules.score"), F.lit(0.0))).alias("score"),
    )
