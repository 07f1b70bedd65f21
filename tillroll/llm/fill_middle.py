"""Fill-in-the-middle: texts are cut at random tokens and their parts reordered.

A token is a run of other characters with the ASCII blanks before it; blanks at the end of
a text are a token of their own. Two ranks are drawn from a hash of the key; the text up to
the smaller is the prefix, up to the larger the middle, and the rest the suffix.

Ranks become places by a learned index. All token boundaries of a piece of texts are one
ascending array, and straight segments are fitted to it: a segment is halved until no
boundary is further than ``ERROR_BOUND`` from its line, so the distance of every boundary
fits in one stored byte. A cut is predicted by its segment's line and corrected exactly by
the stored distance; tests compare the index with the boundaries themselves.

Forms: ``plain`` (the text itself), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix,
prefix, middle), with a marker before each part. Texts that hold a marker stay plain, so a
marker in an output of the other forms always is one, and ``restored`` gives the exact text
back. A null text counts as empty and stays plain; a null key draws as the empty key. Rows
are independent: equal rows give equal results, and nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import small_batches
from tillroll.llm.passing import type_list
from tillroll.llm.text import NOT_BLANK, joined, pieces, runs

SEED = 42
#: Percent of the texts that are reordered, and percent of those in the form ``spm``.
RATE = 50
SPM_RATE = 80

# Markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Farthest distance of a boundary from its segment's line: one signed byte.
ERROR_BOUND = 127
#: Ranks in a segment before it is tested.
FIRST_SEGMENT = 1024


@dataclass
class RankIndex:
    """Lines over an ascending array, and the distance of every value from its line."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residuals: np.ndarray

    def values(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.first, ranks, "right") - 1
        return predicted(self.base[segment], self.slope[segment], ranks - self.first[segment]) + self.residuals[ranks]


def predicted(base: np.ndarray, slope: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return base + np.rint(slope * steps).astype(np.int64)


def fit(values: np.ndarray, bound: int = ERROR_BOUND) -> RankIndex:
    """Index of an ascending array. A segment runs from its first value to its last."""
    n = len(values)
    first = np.arange(0, n, FIRST_SEGMENT)
    while True:
        after = np.append(first[1:], n)
        slope = (values[after - 1] - values[first]) / np.maximum(after - first - 1, 1)
        of_rank = np.repeat(np.arange(len(first)), after - first)
        line = predicted(values[first][of_rank], slope[of_rank], np.arange(n) - first[of_rank])
        away = values - line
        far = np.maximum.reduceat(np.abs(away), first) > bound if n else np.zeros(0, bool)
        if not far.any():
            return RankIndex(first, values[first], slope, away.astype(np.int8))
        # Two values lie on their line, so halving comes to an end.
        first = np.sort(np.append(first, (first[far] + after[far]) // 2))


def boundaries(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of texts and ends of tokens, ascending; rank of each text's start; tokens per text."""
    start, end = runs(NOT_BLANK[data])
    text_start, text_end = bounds[:-1], bounds[1:] - 1
    of_text = np.searchsorted(start, bounds)
    n_words = np.diff(of_text)
    last_end = np.where(n_words > 0, np.append(end, 0)[of_text[1:] - 1], text_start)
    blank_end = text_end > last_end
    places = np.sort(np.concatenate([text_start, end[: of_text[-1]], text_end[blank_end]]))
    return places, np.searchsorted(places, text_start), n_words + blank_end


def draws(key: str) -> tuple[int, int, int, int]:
    """Four unsigned integers from the first 32 hexadecimal digits of the key's SHA-256."""
    return struct.unpack(">4I", hashlib.sha256(key.encode()).digest()[:16])


OUT = "n long, form string, prefix_chars long, middle_chars long, output string"


def transform_piece(texts: pa.Array, keys: list[str], rate: int, spm_rate: int) -> list[pa.Array]:
    data, bounds = joined(texts)
    places, first_rank, n_tokens = boundaries(data, bounds)
    index = fit(places)
    drawn = np.array([draws(key) for key in keys], np.int64).reshape(-1, 4)
    cuts = np.sort(drawn[:, :2] % (n_tokens + 1)[:, None], axis=1)
    low, high = (index.values(first_rank + cuts[:, side]) for side in (0, 1))
    # Code points before each byte: bytes that do not continue a character.
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    whole = data.tobytes()
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    forms, outputs = [], []
    for i, (start, stop) in enumerate(zip(bounds[:-1].tolist(), (bounds[1:] - 1).tolist())):
        text, a, b = whole[start:stop], int(low[i]), int(high[i])
        if not text or drawn[i, 2] % 100 >= rate or any(mark in text for mark in marks):
            forms.append("plain")
            outputs.append(text)
            continue
        before, middle, after = marks[0] + whole[start:a], marks[2] + whole[a:b], marks[1] + whole[b:stop]
        forms.append("spm" if drawn[i, 3] % 100 < spm_rate else "psm")
        outputs.append((after + before if forms[-1] == "spm" else before + after) + middle)
    plain = np.array([form == "plain" for form in forms], bool)
    return [
        pa.array(n_tokens, pa.int64()),
        pa.array(forms, pa.string()),
        pa.array(points[low] - points[bounds[:-1]], pa.int64(), mask=plain),
        pa.array(points[high] - points[low], pa.int64(), mask=plain),
        pa.array(outputs, pa.binary()).cast(pa.string()),
    ]


def fill_in_middle(
    docs: DataFrame,
    columns: list[str],
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """``columns`` of every row with n (tokens), form, prefix_chars, middle_chars and output.

    ``columns`` must not hold these names. The counts of characters are null in plain rows.
    """
    small_batches(docs.sparkSession)
    drawn_from = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = docs.select(F.struct(*columns).alias("_kept"), drawn_from.alias("_key"), F.col(text).alias("text"))
    names = [field.split()[0] for field in OUT.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                made = transform_piece(piece.column("text"), piece.column("_key").to_pylist(), rate, spm_rate)
                yield pa.record_batch([piece.column("_kept"), *made], ["_kept", *names])

    made = rows.mapInArrow(cut, f"{type_list(rows, ['_kept'])}, {OUT}")
    return made.select("_kept.*", *names)


def restored(output: Column, form: Column) -> Column:
    """The exact text, from an output and its form."""

    def between(text: Column, after: str, before: str | None = None) -> Column:
        rest = F.split_part(text, F.lit(after), F.lit(2))
        return F.split_part(rest, F.lit(before), F.lit(1)) if before else rest

    psm = F.concat(between(output, PREFIX, SUFFIX), between(output, MIDDLE), between(output, SUFFIX, MIDDLE))
    spm = F.concat(between(output, PREFIX, MIDDLE), between(output, MIDDLE), between(output, SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) of every row."""

    def sha(text: Column) -> Column:
        return F.sha2(text.cast("binary"), 256)

    made = fill_in_middle(docs, ["doc_id"])
    return made.select(
        *[name for name in made.columns if name != "output"],
        sha(F.col("output")).alias("output_sha256"),
        sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


#: The same rows in SQL.
SQL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
  FROM documents),
drawn AS (
  SELECT doc_id, text, tokens, len(tokens) AS n,
         CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
         CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
  FROM cut),
parts AS (
  SELECT doc_id, text, n,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50
              THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(tokens[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
         array_to_string(tokens[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
         array_to_string(tokens[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS suffix
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
