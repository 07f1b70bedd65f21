"""N-gram Jaccard join: rare-first prefix filtering, exact verification, link components.

A document is the set of its distinct five-word shingles (words are runs of bytes other
than ASCII blanks, A-Z lower-cased); a shorter text is one shingle, and a text without
words has no shingle and no link. Two documents link when 100 * intersection is at least
80 * union. Shingles are compared by 64-bit hashes, so two sets of n shingles could
differ from their texts only with a chance of about n*n / 2**64.

1. Equal sets become one class, by a 128-bit digest; the smallest id represents it.
2. Shingles are ordered rare first, by counts over all documents in a fixed-size sketch,
   ties by hash. Any common order is correct; this one keeps frequent shingles out of
   the prefixes. Of n shingles the first n - ceil(0.8 n) + 1 are indexed: two documents
   that link share one of them.
3. Documents that share an indexed shingle and pass the length and positional filters
   are candidates. First, each is compared with one document of its shingle only, the one
   that shares most indexed shingles with others, and the links give components. Then all remaining candidate pairs between
   different components are compared. A pair inside a component needs no second look,
   so a group of thousands of near copies costs about one comparison each, and no link
   between components is lost.
4. A suffix filter bounds what two candidates can share: their hashes are cut into about
   two slices per shingle, and every slice with an odd size in one set and an even one in
   the other holds a shingle that is not common. Only one bit per slice is compared.
5. What is left is verified once per pair on whole sets.

Rows with the same id count as one document with several texts: links of either text
are its links. Rows without an id are taken as one such document. The result has one row
per input row. The stage of the pipeline (``without_near_duplicates``) takes every id and
text as a document of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import small_batches
from tillroll.llm.components import components
from tillroll.llm.passing import id_set, likely_and_others, passing, row_key
from tillroll.llm.text import shingle_sets, word_pieces
from tillroll.llm.vectors import BitSet, add_up, packed
from tillroll.staging import stage

#: Cells of the frequency sketch.
CELLS = 1 << 22
CELL_SHIFT = np.uint64(64 - 22)
#: Stands for a missing id inside the join.
NO_ID = -(1 << 63)


def least_overlap(a, b):
    """Fewest common shingles with which sets of ``a`` and ``b`` shingles link."""
    return -(-4 * (a + b) // 9)


def prefix_length(n: int) -> int:
    return n - -(-4 * n // 5) + 1


def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n, two halves of the set's digest) per row, and at the end this task's sketch."""
    sketch = np.zeros(CELLS, np.int32)
    for piece, words in word_pieces(batches):
        sizes, digests, slices = [], [], []
        for found in shingle_sets(words):
            sizes.append(len(found))
            slices.append(odd_slices(found))
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            np.add.at(sketch, (found >> CELL_SHIFT).astype(np.int64), 1)
        halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        yield pa.record_batch(
            [
                piece.column("id"),
                pa.array(sizes, pa.int64()),
                pa.array(np.ascontiguousarray(halves[:, 0])),
                pa.array(np.ascontiguousarray(halves[:, 1])),
                pa.array(slices, pa.binary()),
                pa.nulls(piece.num_rows, pa.binary()),
            ],
            MEASURED,
        )
    empty = pa.array([None], pa.int64())
    none = pa.array([None], pa.binary())
    yield pa.record_batch([empty, empty, empty, empty, none, pa.array([packed(sketch)], pa.binary())], MEASURED)


MEASURED = ["id", "n", "half1", "half2", "slices", "sketch"]


def odd_slices(found: np.ndarray) -> bytes:
    """One bit per slice of the hashes, two or more slices per shingle: whether its size is odd."""
    log_slices = max(6, int(2 * len(found)).bit_length())
    sizes = np.bincount((found >> np.uint64(64 - log_slices)).astype(np.int64), minlength=1 << log_slices)
    return np.packbits(sizes.astype(np.uint8) & 1).tobytes()


def may_link(n_a: int, slices_a: bytes, n_b: int, slices_b: bytes) -> bool:
    """False only if the slices show too many shingles that are not common."""
    bits = [np.unpackbits(np.frombuffer(slices, np.uint8)) for slices in (slices_a, slices_b)]
    size = min(map(len, bits))
    a, b = (np.bitwise_xor.reduce(each.reshape(size, -1), axis=1) for each in bits)
    return np.count_nonzero(a != b) <= n_a + n_b - 2 * least_overlap(n_a, n_b)


def suffix_filter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose sizes and slices allow a link."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("n_a", "slices_a", "n_b", "slices_b")))
        yield batch.filter(pa.array([may_link(*row) for row in rows], pa.bool_())).select(["a", "b"])


def filtered(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs that pass the suffix filter by the (id, n, slices) of their documents."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    likely, _ = likely_and_others(sizes.filter("n > 0").select("id", "n", "slices"), ids, "id")
    # Staged, so no task runs two Python workers, one for the ids and one for the pairs.
    likely = stage(likely, "likely")
    left = likely.toDF("a", "n_a", "slices_a")
    right = likely.toDF("b", "n_b", "slices_b")
    return pairs.join(left, "a").join(right, "b").mapInArrow(suffix_filter, "a long, b long").distinct()


def prefixes(sketch: np.ndarray):
    """(shingle, id, n, place) of the indexed shingles; equal sets once per task."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for piece, words in word_pieces(batches):
            shingles, ids, sizes, places = [], [], [], []
            for row, found in zip(piece.column("id").to_pylist(), shingle_sets(words)):
                if not len(found):
                    continue
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                if digest in seen:
                    continue
                seen.add(digest)
                rare_first = np.argsort(sketch[(found >> CELL_SHIFT).astype(np.int64)], kind="stable")
                first = found[rare_first[: prefix_length(len(found))]]
                shingles.append(first)
                ids.append(np.full(len(first), row))
                sizes.append(np.full(len(first), len(found)))
                places.append(np.arange(len(first)))
            if shingles:
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate(shingles).view(np.int64)),
                        pa.array(np.concatenate(ids)),
                        pa.array(np.concatenate(sizes).astype(np.int32)),
                        pa.array(np.concatenate(places).astype(np.int32)),
                    ],
                    ["shingle", "id", "n", "place"],
                )

    return index


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[dict[str, np.ndarray]]:
    """Sorted batches as column arrays that hold whole groups of ``key``."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1]))
        if cut == 0:
            if rest and rest[-1].column(key)[len(rest[-1]) - 1].as_py() != keys[0]:
                yield as_arrays(rest)
                rest = []
            rest.append(batch)
            continue
        yield as_arrays([*rest, batch.slice(0, cut)])
        rest = [batch.slice(cut)]
    if rest:
        yield as_arrays(rest)


def as_arrays(batches: list[pa.RecordBatch]) -> dict[str, np.ndarray]:
    table = pa.Table.from_batches(batches)
    return {name: table.column(name).to_numpy() for name in table.column_names}


def group_bounds(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop the shingles that only one row has."""
    for rows in whole_groups(batches, "shingle"):
        keys = rows["shingle"]
        same = keys[1:] == keys[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        yield pa.record_batch([pa.array(values[keep]) for values in rows.values()], list(rows))


def passes(n_a, place_a, n_b, place_b):
    """Length and positional filter, on arrays."""
    fits = (5 * n_a >= 4 * n_b) & (5 * n_b >= 4 * n_a)
    return fits & (np.minimum(n_a - place_a, n_b - place_b) >= least_overlap(n_a, n_b))


def candidate_pairs(every: bool):
    """Candidates (a, b) of each shingle, across components only.

    With the first row of each shingle, or of all rows for ``every``.
    """

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "shingle"):
            bounds = group_bounds(rows["shingle"])
            ids, n, place, component = (rows[c].astype(np.int64) for c in ("id", "n", "place", "component"))
            if not every:
                first = np.repeat(bounds[:-1], np.diff(bounds))
                keep = passes(n[first], place[first], n, place) & (component[first] != component)
                yield pairs_batch(ids[first][keep], ids[keep])
                continue
            # Rows of shingles with several components, and where each one's shingle ends.
            mixed = np.minimum.reduceat(component, bounds[:-1]) != np.maximum.reduceat(component, bounds[:-1])
            end = np.repeat(bounds[1:], np.diff(bounds))
            row = np.flatnonzero(np.repeat(mixed, np.diff(bounds)))
            apart = 1
            while len(row := row[row + apart < end[row]]):
                other = row + apart
                keep = passes(n[row], place[row], n[other], place[other]) & (component[row] != component[other])
                if keep.any():
                    yield pairs_batch(ids[row[keep]], ids[other[keep]])
                apart += 1

    return pair


def pairs_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def sets_of(wanted: BitSet):
    """(id, set) of the rows whose id may be in the bit set; one Python worker does both."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, words in word_pieces(passing(wanted, "id")(batches)):
            found = [shingles.tobytes() for shingles in shingle_sets(words)]
            yield pa.record_batch([piece.column("id"), pa.array(found, pa.binary())], ["id", "shingles"])

    return find


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets link."""
    both = np.sort(np.concatenate([a, b]), kind="stable")
    return np.count_nonzero(both[1:] == both[:-1]) >= least_overlap(len(a), len(b))


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among sorted rows (a, b, set of b), where the rows of a itself come first."""
    hub, hub_sets = None, []
    for batch in batches:
        found = []
        for a, b, own, data in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "own", "shingles"))):
            if a != hub:
                hub, hub_sets = a, []
            shingles = np.frombuffer(data, np.uint64)
            if own:
                hub_sets.append(shingles)
            elif any(links(one, shingles) for one in hub_sets):
                found.append((a, b))
        yield pa.record_batch(
            [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], ["a", "b"]
        )


def verified(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose documents link. Sets are computed for documents in a pair only."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    found = rows.mapInArrow(sets_of(id_set(needed, "id")), "id long, shingles binary").withColumnRenamed("id", "b")
    hubs = pairs.select("a").distinct().select("a", F.col("a").alias("b"), F.lit(True).alias("own"))
    asked = pairs.select("a", "b", F.lit(False).alias("own")).union(hubs)
    with_sets = asked.join(found, "b").select("a", "b", "own", "shingles")
    met = with_sets.repartition("a").sortWithinPartitions("a", F.col("own").desc())
    return met.mapInArrow(verify, "a long, b long")


def similarity_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) per row of ``docs``; see the module for the rules."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), F.col(text).alias("text"))
    sizes = stage(rows.mapInArrow(measured, "id long, n long, half1 long, half2 long, slices binary, sketch binary"), "sets")
    sketch = add_up(sizes.select("sketch"), "sketch", CELLS, np.int32)

    sizes = sizes.filter("sketch IS NULL").drop("sketch")
    classes = sizes.filter("n > 0").groupBy("n", "half1", "half2").agg(F.min("id").alias("class"))
    members = stage(
        sizes.drop("slices").join(classes, ["n", "half1", "half2"], "left").select("id", "n", F.coalesce("class", "id").alias("class")),
        "members",
    )

    index = rows.mapInArrow(prefixes(sketch), "shingle long, id long, n int, place int")
    often = stage(index.repartition("shingle").sortWithinPartitions("shingle").mapInArrow(shared, index.schema), "index")
    own_class = members.select("id", "class", F.col("n").cast("int").alias("n")).distinct()
    # The original of a group of edited copies has all its shingles in common with others.
    degrees = often.groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    index = stage(
        often.join(own_class.join(degrees, "id"), ["id", "n"]).select("shingle", F.col("class").alias("id"), "n", "place", "degree"),
        "index",
    )

    same = members.filter("id <> class").select(F.col("class").alias("a"), F.col("id").alias("b"))
    found, component = same, None
    tested = None
    for every in (False, True):
        placed = (
            index.withColumn("component", F.col("id"))
            if component is None
            else index.join(component.withColumnRenamed("node", "id"), "id", "left").withColumn(
                "component", F.coalesce("component", "id")
            )
        )
        met = placed.select("shingle", "id", "n", "place", "component", "degree").repartition("shingle")
        pairs = met.sortWithinPartitions("shingle", F.desc("degree"), "id").mapInArrow(candidate_pairs(every), "a long, b long")
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = pairs
        found = found.union(stage(verified(rows, stage(filtered(pairs, sizes), "filtered")), "links"))
        component = components(found)

    result = members.join(component.withColumnRenamed("node", "id"), "id", "left")
    whole = lambda column: F.nullif(column, F.lit(NO_ID))
    return result.select(
        whole(F.col("id")).alias(key),
        F.col("n").alias("n_shingles"),
        whole(F.coalesce("component", "id")).alias("component_id"),
    )


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """``documents`` with one row per group of links: that of the group's smallest id.

    Rows are joined by a key of id and text, so texts that only share an id, or have none,
    are documents of their own; a missing id comes before all others. Of rows with equal
    ids and texts one stays. Only rows that may be dropped or repeated are compared; all
    others pass by without a shuffle.
    """
    # In a struct no column of the input can clash with those of the join.
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_whole")
    keyed = docs.select(row_key().alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("text"), whole)
    linked = similarity_components(keyed, "_row").filter("_row <> component_id")
    linked = stage(linked.select("_row", F.col("component_id").alias("_group")).distinct(), "linked")
    members = linked.union(linked.select(F.col("_group").alias("_row"), "_group").distinct())
    likely, _ = likely_and_others(keyed.select("_row", "_id"), members, "_row")
    named = likely.distinct().join(members, "_row")
    first = named.groupBy("_group").agg(F.min(F.struct("_id", "_row")).alias("first")).select("first._row")
    dropped = members.select("_row").join(first, "_row", "left_anti")
    repeated = keyed.groupBy("_row").agg((F.count(F.lit(1)) > 1).alias("again")).filter("again")
    listed = stage(
        dropped.withColumn("gone", F.lit(True)).union(repeated.select("_row", F.lit(False))), "listed"
    )
    likely, others = likely_and_others(keyed.select("_row", "_whole"), listed, "_row")
    kept = likely.join(listed.filter("gone").select("_row"), "_row", "left_anti")
    # Copies of a row collapse before the shuffle.
    columns = [F.col(f"_whole.`{name}`") for name in docs.columns]
    kept = kept.groupBy("_row").agg(F.min_by("_whole", F.xxhash64(*columns)).alias("_whole"))
    return others.select("_whole.*").unionByName(kept.select("_whole.*"))
