"""Mixing sources to target weights with balanced samples by the cube method.

A document's size is its number of words (runs of characters other than blanks, none in a
null text). Sources in the order of their code points, null last, weigh 1, 2, 3, 1, ...;
by weight they share the total size of all documents. A source's target stops at
``MOST_COPIES`` times its own size, and the excess is shared among the others by weight
until none is above.

With r = target / size of the source, each of its documents is taken floor(r) times, and
once more with probability r - floor(r). Those extra takes are a balanced sample: moving
along the null space of the constraints, the flight phase turns probabilities into 0 or 1
while the expected number of documents and of words of the source stay exactly as they
are, until two documents at most are undecided. Every block of a source flies on its own,
as a stream; what it leaves undecided flies again with that of many other blocks, until
one block per source is left. Its undecided and last ``LANDING`` documents land where the
words come closest to the target.

Choices depend only on ids, sources and sizes, so reruns agree. Empty documents are never
taken. A source of few documents can miss its target by about one of them. Rows with the
same id are separate documents of one block. All sources pass one task, one row each.
"""

from __future__ import annotations

import random
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.batches import small_batches
from tillroll.llm.passing import id_set, row_key
from tillroll.llm.text import NOT_BLANK, joined, mix, pieces, runs
from tillroll.staging import stage

MOST_COPIES = 3
#: Documents per block of a flight, on average.
BLOCK = 2000
#: Documents per source that are decided in the landing, besides the two left by the flight.
LANDING = 64
CLOSE = 1e-9
#: Bits of the set of rows that are taken so many times.
LOG_BITS = 24


def sizes(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every row with its ``size`` in words."""
    rows = docs.select(*columns, F.col(text).alias("text"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*columns).schema.fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                data, bounds = joined(piece.column("text"))
                found = np.diff(np.searchsorted(runs(NOT_BLANK[data])[0], bounds))
                yield pa.record_batch([*[piece.column(c) for c in columns], pa.array(found.astype(np.int64))], [*columns, "size"])

    return rows.mapInArrow(count, f"{types}, size long")


def targets(sized: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, documents, source_size, target) of every source with its weight's share.

    With sources in the order of most * size / weight, a source is capped if its cap is
    no more than its share of what the sources before it leave; from the first that is
    not capped on, none is.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("documents"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = per_source.withColumn("weight", ((F.row_number().over(in_order) - 1) % 3 + 1).cast("double"))
    weighted = weighted.withColumn("cap", F.col("source_size") * float(most))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    after = by_cap.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ranked = weighted.withColumns({"level": left / F.sum("weight").over(after), "place": F.row_number().over(by_cap)})
    ranked = ranked.withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level"))
    first_free = F.min(F.when(~F.col("capped"), F.struct("place", "level"))).over(whole)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * first_free["level"])
    return ranked.select("source", "documents", "source_size", target.alias("target"))


def direction(units: list[list]) -> tuple[float, ...] | None:
    """A move of the units' probabilities that keeps their sum and their words, or None.

    A unit is [probability, size, its row of source, doc_id, size, documents and row].
    """
    if len(units) == 3:
        a, b, c = (unit[1] for unit in units)
        return (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
    if len(units) == 2 and units[0][1] == units[1][1]:
        return (1.0, -1.0)
    return None


def fly(units: list[list], move: tuple[float, ...], chance: float) -> None:
    """Move probabilities along ``move`` or against it until one of them is 0 or 1."""

    def room(sign: float) -> float:
        steps = [((1 - unit[0]) if sign * step > 0 else unit[0]) / abs(step) for unit, step in zip(units, move) if step]
        return min(steps)

    forth, back = room(1.0), room(-1.0)
    step = forth if chance * (forth + back) < back else -back
    for unit, by in zip(units, move):
        moved = unit[0] + step * by
        unit[0] = 0.0 if moved < CLOSE else 1.0 if moved > 1 - CLOSE else moved


def land(units: list[list], dice: random.Random) -> None:
    """Decide the last units: by chance first, then by the changes that best mend the words.

    Single units change, or two at once, as long as the words come closer to what the
    probabilities ask for; with some documents of ordinary size among the units, a very
    large one is made up for.
    """
    off = -sum(unit[0] * unit[1] for unit in units)
    for unit in units:
        unit[0] = float(dice.random() < unit[0])
        off += unit[0] * unit[1]
    while True:
        gain = [unit[1] * (1 - 2 * unit[0]) for unit in units]  # change of words if the unit changes
        ways = [(i,) for i in range(len(units))] + [(i, j) for i in range(len(units)) for j in range(i)]
        best = min(ways, key=lambda way: abs(off + sum(gain[i] for i in way)), default=())
        change = sum(gain[i] for i in best)
        if abs(off + change) >= abs(off) - CLOSE:
            return
        off += change
        for i in best:
            units[i][0] = 1 - units[i][0]


def flight(last: bool):
    """Flight of each block of sorted rows as a stream; the last flight ends in a landing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, dice, units, waiting = None, random.Random(), [], deque()

        def end() -> list[tuple]:
            rest = [*units, *waiting]
            if last:
                land(rest, dice)
            return [(*unit[2], unit[0]) for unit in rest]

        for batch in batches:
            decided: list[tuple] = []
            for row in zip(*(batch.column(name).to_pylist() for name in ["block", *FLOWN])):
                if row[:2] != block:
                    decided += end()
                    block, units, waiting = row[:2], [], deque()
                    dice = random.Random(f"{block}")
                waiting.append([row[6], row[3], row[1:6]])
                if len(waiting) <= LANDING * last:
                    continue
                units.append(waiting.popleft())
                while (move := direction(units)) is not None:
                    fly(units, move, dice.random())
                    decided += [(*unit[2], unit[0]) for unit in units if unit[0] in (0.0, 1.0)]
                    units = [unit for unit in units if unit[0] not in (0.0, 1.0)]
            yield flown(decided)
        yield flown(end())

    return run


def flown(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 6
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
    return pa.record_batch([pa.array(column, kind) for column, kind in zip(columns, kinds)], FLOWN)


FLOWN = ["source", "doc_id", "size", "documents", "row", "p"]


def balanced_sample(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """(source, doc_id, size, documents, p) with p 0 or 1, balanced within each source.

    ``units`` has the same columns with probabilities between 0 and 1 and the number of
    documents of the source, and may have ``row``, which tells rows of one id apart.
    """
    if "row" not in units.columns:
        return balanced_sample(units.withColumn("row", F.lit(0).cast("long")), block).drop("row")
    open_units, done, rows = units, [], units.agg(F.max("documents")).first()[0] or 0
    while True:
        last = rows <= block
        # Each block leaves two units at most, and the last block per source none.
        n_blocks = F.lit(1) if last else F.ceil(F.col("documents") / F.lit(block))
        mixed = F.xxhash64("doc_id", "size", F.lit(len(done)))
        placed = open_units.withColumn("block", F.pmod(mixed, n_blocks.cast("long"))).withColumn("h", mixed)
        met = placed.repartition("source", "block").sortWithinPartitions("source", "block", "h", "doc_id", "size", "row")
        result = stage(met.select("block", *FLOWN).mapInArrow(flight(last), "source string, doc_id long, size long, documents long, row long, p double"), "flight")
        done.append(result if last else result.filter("p IN (0, 1)"))
        if last:
            break
        open_units = result.filter("p NOT IN (0, 1)").withColumn("documents", F.ceil(F.col("documents") * 2 / F.lit(block)).cast("long"))
        rows = -(-rows * 2 // block)
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def mixture(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) of every row of ``docs``.

    ``taken`` is size times copies: the words that the mix takes of the document.
    """
    return mixed_rows(docs.withColumn("row", F.lit(0).cast("long"))).drop("row")


def mixed_rows(docs: DataFrame) -> DataFrame:
    """As ``mixture``, with the long ``row`` of every row. Ids decide the sample, not rows."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "row", "text")
    sized = stage(sizes(rows, ["doc_id", "source", "row"]), "sizes")
    goals = stage(targets(sized), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + CLOSE)
    goals = goals.withColumns({"whole": whole, "p": F.greatest(ratio - whole, F.lit(0.0))})
    per_row = sized.join(goals.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    extra = (F.col("p") > CLOSE) & (F.col("size") > 0)
    sampled = balanced_sample(per_row.filter(extra).select(*FLOWN))
    columns = ["source", "doc_id", "size", "row"]
    decided = sampled.select(*columns, "p").unionByName(per_row.filter(~extra).select(*columns, F.lit(0.0).alias("p")))
    result = decided.join(goals.withColumnRenamed("source", "of").drop("p"), F.col("source").eqNullSafe(F.col("of")))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("p").cast("long")).otherwise(F.lit(0)).cast("long")
    return result.select(
        "doc_id", "source", "row", "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """``documents`` that the mix takes, with ``copies``, how often it takes each.

    A row is known by its id, text and source, so rows without an id, or with one id and
    different texts, are documents of their own. Rows that are equal in all three become
    one, with the copies of all of them. An input column ``copies`` is replaced. Only rows
    whose copies ``known_copies`` leaves open are shuffled.
    """
    columns = [name for name in docs.columns if name != "copies"]
    whole = F.struct(*[F.col(f"`{name}`") for name in columns]).alias("_whole")
    source = F.col("source").cast("string").alias("source")
    keyed = docs.select("doc_id", row_key().alias("row"), source, F.col("text").alias("text"), whole)
    chosen = mixed_rows(keyed).groupBy(F.col("row").alias("_row"), F.col("source").alias("_of"))
    chosen = stage(chosen.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("_rows")), "chosen")
    known = known_copies(chosen)
    rows = keyed.drop("doc_id", "text").withColumn("_copies", known(F.col("row")))
    sure = rows.filter("_copies > 0").select("_whole.*", F.col("_copies").cast("long").alias("copies"))
    rows, chosen = rows.filter("_copies < 0").drop("_copies"), chosen.filter("copies > 0").filter(known(F.col("_row")) < 0)
    same = (F.col("row") == F.col("_row")) & F.col("source").eqNullSafe(F.col("_of"))
    # Staged apart, the planner knows that those of several rows are few.
    once = rows.join(stage(chosen.filter("_rows = 1"), "mixed"), same).select("_whole.*", "copies")
    often = rows.join(stage(chosen.filter("_rows > 1"), "mixed-copies"), same).groupBy("_row", "_of")
    often = often.agg(F.first("_whole").alias("_whole"), F.first("copies").alias("copies"))
    return sure.unionByName(once).unionByName(often.select("_whole.*", "copies"))


def known_copies(chosen: DataFrame) -> Callable[[Column], Column]:
    """The copies of a row by its key, as a column; -1 if the row has to meet the list ``chosen``.

    There is one bit set of fixed size per number of copies. A key in one of them alone has
    that number. Keys of several rows are in two sets, and so are a few others by chance, the
    more the larger the list.
    """
    several = F.col("_rows") > 1
    numbers = range(MOST_COPIES + 1)
    sets = [id_set(chosen.filter(several | (F.col("copies") == n)), "_row", LOG_BITS) for n in numbers]

    @F.pandas_udf("int")
    def copies(keys: pd.Series) -> pd.Series:
        hashes = mix(keys.to_numpy(np.int64).view(np.uint64))
        listed = np.array([each.has(hashes) for each in sets])
        return pd.Series(np.where(listed.sum(axis=0) == 1, listed.argmax(axis=0), -1).astype(np.int32))

    return copies.asNondeterministic()
