"""Prefix trie of rebuilt conversations, as node tables with minimal perfect hashing.

A conversation c is rebuilt from the first h turns of conversation c - c % 100 and its own
turns after its first h, h being the CRC-32 of its decimal number modulo ``MOST_BORROWED``
+ 1. Every distinct sequence of first turns is a node.

1. Turns are numbered over a global order, so one conversation may hold any share of the
   rows. The digest of a prefix is the sum of hashes of (place, turn) up to there, in four
   words of 32 bits: sums run over slices as the numbers do, so it needs no chain. A node
   compares its members' last turns and parents; a collision fails the job.
2. Distinct digests are counted into nodes. The turns below a node (its members' lengths
   less its depth) bound its subtree. Nodes with more than a shard's worth are heavy; they
   are the top of the trie. What hangs below them is light, and a shard is a whole light
   subtree.
3. In a shard, digests get slots of a minimal perfect hash, every lookup is verified by the
   digest stored in the slot, counts are scattered into flat arrays, and totals are added
   to parents' slots from the deepest level to the first.
4. Heavy nodes with one smallest member are a chain: about one per shard, of which there are
   ``MOST_SHARDS`` at most, and their totals are added up in one table. (Chains that end above
   others, as every conversation is the beginning of a longer one, come on top; with turns
   T below a light node they are less than the square root of 2 T per shard.) Within a chain
   totals are running sums, so one long conversation is no long task.
5. The members that end at a node are written into blocks of ids by a range shuffle, and
   blocks are hashed in order, so a node that a third of all conversations share is a few
   blocks to the task that hashes it.

Rows without a conversation id belong to none and are left out. A null role or text is
empty. Turns with equal numbers go by role, then by a digest of role and text; equal rows
are turns of their own. ``c % 100`` has the sign of c. Without conversations there is no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.text import mix
from tillroll.staging import stage

#: Conversations with numbers that differ in the last two digits may share turns.
FAMILY = 100
MOST_BORROWED = 5
#: Turns below a light node, unless there were more than ``MOST_SHARDS`` such shards.
SHARD_TURNS = 1 << 13
MOST_SHARDS = 1 << 20
#: Nodes that a table of whole shards starts to be built at.
TABLE_NODES = 1 << 16
#: Equal rows, and ids of members, that are one row of a shuffle.
BLOCK = 1 << 12

WORD = (1 << 32) - 1


def running_sums(df: DataFrame, by: str, order: list[str], names: list[str]) -> DataFrame:
    """Replace each of ``names`` by its sum up to and with the row, within ``by``, in a unique ``order``.

    Rows are cut into contiguous slices. A slice has at most one value of ``by`` that began
    before it, so there are fewer offsets than slices.
    """
    sliced = stage(df.repartitionByRange(by, *order).withColumn("_slice", F.spark_partition_id()), "sliced")
    sums = sliced.groupBy(by, "_slice").agg(*[F.sum(name).alias(name) for name in names])
    earlier = Window.partitionBy(by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(by, "_slice", *[F.sum(name).over(earlier).alias(f"_{name}") for name in names])
    offsets = stage(offsets.filter(F.col(f"_{names[0]}").isNotNull()), "offsets")
    within = Window.partitionBy(by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = sliced.join(offsets, [by, "_slice"], "left").withColumns(
        {name: F.coalesce(f"_{name}", F.lit(0)) + F.sum(name).over(within) for name in names}
    )
    return summed.select(*df.columns)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, said, chars) of every turn, positions from 1."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    said = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.substring(said, 1, 16).alias("said"),
        F.length(text).cast("long").alias("chars"),
    )
    order = ["turn", "role", "said"]
    counted = turns.groupBy("conv_id", *order, "chars").agg(F.count(F.lit(1)).alias("upto"))
    counted = running_sums(counted.withColumn("copies", F.col("upto")), "conv_id", order, ["upto"])
    blocks = counted.withColumn("block", F.explode(F.sequence(F.col("upto") - F.col("copies") + 1, "upto", F.lit(BLOCK).cast("long"))))
    # The copies of a row that is there very often leave it in blocks.
    often = F.col("copies") > BLOCK
    blocks = blocks.filter(~often).unionByName(blocks.filter(often).repartition("conv_id", "block"))
    last = F.least(F.col("block") + BLOCK - 1, "upto")
    return blocks.select("conv_id", F.explode(F.sequence("block", last)).alias("position"), "said", "chars")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, base, h, borrowed, length) of every rebuilt conversation."""
    own = stage(turns.groupBy("conv_id").agg(F.max("position").alias("own")), "lengths")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_BORROWED + 1)).alias("h")
    asked = own.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), h)
    bases = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_length"))
    borrowed = F.least("h", F.coalesce("base_length", F.lit(0).cast("long")))
    return asked.join(bases, "base", "left").select(
        "conv_id", "base", "h", borrowed.alias("borrowed"), (borrowed + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")
    )


def rebuilt(turns: DataFrame, known: DataFrame) -> DataFrame:
    """(conv_id, length, depth, said, chars): the turns of the rebuilt conversations."""
    first = turns.filter(F.col("position") <= MOST_BORROWED).withColumnRenamed("conv_id", "base")
    borrowed = known.join(first, "base").filter(F.col("position") <= F.col("borrowed"))
    kept = turns.join(known, "conv_id").filter(F.col("position") > F.col("h"))
    columns = ["said", "chars"]
    return borrowed.select("conv_id", "length", F.col("position").alias("depth"), *columns).unionByName(
        kept.select("conv_id", "length", (F.col("position") - F.col("h") + F.col("borrowed")).alias("depth"), *columns)
    )


def digest(high: Column, low: Column) -> Column:
    """Two sums of words as one integer."""
    return F.shiftleft(high.bitwiseAND(F.lit(WORD)), 32).bitwiseOR(low.bitwiseAND(F.lit(WORD)))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, length, depth, chars, mark, hi, lo, parent_hi, parent_lo) of every prefix but the empty one.

    A digest is a sum of hashes of (depth, turn); ``mark`` is the hash of the last turn.
    """
    marked = turns.withColumns({name: F.xxhash64(F.lit(name), "depth", "said") for name in ("mark", "other")})
    own = [
        word
        for name in ("mark", "other")
        for word in (F.shiftrightunsigned(name, 32), F.col(name).bitwiseAND(F.lit(WORD)))
    ]
    words = marked.select("conv_id", "length", "depth", "chars", "mark", *[w.alias(f"{c}{i}") for c in "ws" for i, w in enumerate(own)])
    summed = running_sums(words, "conv_id", ["depth"], ["s0", "s1", "s2", "s3"])
    upto = [F.col(f"s{i}") for i in range(4)]
    before = [F.col(f"s{i}") - F.col(f"w{i}") for i in range(4)]
    return summed.select(
        *["conv_id", "length", "depth", "chars", "mark"],
        digest(upto[0], upto[1]).alias("hi"),
        digest(upto[2], upto[3]).alias("lo"),
        digest(before[0], before[1]).alias("parent_hi"),
        digest(before[2], before[3]).alias("parent_lo"),
    )


def trie_nodes(paths: DataFrame, known: DataFrame) -> DataFrame:
    """(depth, hi, lo, parent_hi, parent_lo, conv_id, n_convs, chars, below) of every node."""
    alike = ["parent_hi", "parent_lo", "mark", "chars"]
    counted = paths.groupBy("depth", "hi", "lo").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.sum(F.col("length") - F.col("depth")).alias("below"),
        *[F.min(name).alias(name) for name in alike],
        *[F.max(name).alias(f"{name}_") for name in alike],
    )
    same = F.lit(True)
    for name in alike:
        same = same & (F.col(name) == F.col(f"{name}_"))
    columns = ["depth", "hi", "lo", "parent_hi", "parent_lo", "conv_id", "n_convs", "chars", "below"]
    zero = F.lit(0).cast("long")
    root = known.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.coalesce(F.sum("length"), zero).alias("below")
    ).filter("n_convs > 0")
    root = root.withColumns({name: zero for name in ("depth", "hi", "lo", "parent_hi", "parent_lo", "chars")})
    sure = counted.filter(F.when(same, True).otherwise(F.raise_error(F.lit("two prefixes have one digest"))))
    return sure.select(*columns).unionByName(root.select(*columns))


class NodeTable:
    """Minimal perfect hash over distinct 128-bit digests.

    On each level the digests that are left fall into twice as many cells; one that is
    alone in its cell gets the next slot. ``hi`` and ``lo`` by slot verify every lookup.
    """

    def __init__(self, hi: np.ndarray, lo: np.ndarray) -> None:
        self.hi, self.lo = np.empty_like(hi), np.empty_like(lo)
        self.levels: list[np.ndarray] = []
        left, used = np.arange(len(hi)), 0
        while len(left):
            if len(self.levels) > 64:
                raise ValueError("digests are not distinct")
            cells = np.full(2 * len(left), -1, np.int64)
            cell = self.cells(hi[left], lo[left], len(self.levels), len(cells))
            alone = np.bincount(cell, minlength=len(cells))[cell] == 1
            slots = used + np.arange(np.count_nonzero(alone))
            cells[cell[alone]] = slots
            self.hi[slots], self.lo[slots] = hi[left[alone]], lo[left[alone]]
            self.levels.append(cells)
            left, used = left[~alone], used + len(slots)

    @staticmethod
    def cells(hi: np.ndarray, lo: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = mix(np.array([level + 1], np.uint64))
        return (mix(mix(hi.view(np.uint64) + seed) + lo.view(np.uint64)) % np.uint64(size)).astype(np.int64)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Slot of each digest, -1 for those that have none."""
        found, left = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for level, cells in enumerate(self.levels):
            slot = cells[self.cells(hi[left], lo[left], level, len(cells))]
            sure = (slot >= 0) & (self.hi[slot] == hi[left]) & (self.lo[slot] == lo[left])
            found[left[sure]] = slot[sure]
            left = left[~sure]
        return found


def add_to_parents(parent: np.ndarray, depth: np.ndarray, *totals: np.ndarray) -> None:
    """Add every slot's totals to its parent's, the deepest level first; parent -1 is none."""
    order = np.argsort(-depth, kind="stable")
    order = order[parent[order] >= 0]
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in np.split(order, cuts):
        for total in totals:
            np.add.at(total, parent[level], total[level])


LIGHT = (
    "depth long, hi long, lo long, parent_hi long, parent_lo long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long"
)


def shard_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of the nodes of whole shards; rows come in order of shard."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        shard = batch.column("shard_hi").to_numpy(), batch.column("shard_lo").to_numpy()
        changes = np.flatnonzero((shard[0][1:] != shard[0][:-1]) | (shard[1][1:] != shard[1][:-1]))
        if len(changes) and sum(len(part) for part in held) + len(batch) >= TABLE_NODES:
            cut = int(changes[-1]) + 1
            yield light_totals(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held, batch = [], batch.slice(cut)
        held.append(batch)
    if sum(len(part) for part in held):
        yield light_totals(pa.Table.from_batches(held))


def light_totals(nodes: pa.Table) -> pa.RecordBatch:
    column = {name: nodes.column(name).to_numpy() for name in nodes.column_names}
    table = NodeTable(column["hi"], column["lo"])
    own = table.slots(column["hi"], column["lo"])

    def scattered(values: np.ndarray) -> np.ndarray:
        by_slot = np.empty(len(own), np.int64)
        by_slot[own] = values
        return by_slot

    parent = scattered(table.slots(column["parent_hi"], column["parent_lo"]))
    depth, conv_id = scattered(column["depth"]), scattered(column["conv_id"])
    saved = scattered((column["n_convs"] - 1) * column["chars"])
    children = np.bincount(parent[parent >= 0], minlength=len(own))
    leaves = (children == 0).astype(np.int64)
    add_to_parents(parent, depth, leaves, saved)
    parent_conv = pa.array(conv_id[parent], mask=parent < 0)
    return pa.record_batch(
        [
            *[pa.array(column[name]) for name in ("depth", "hi", "lo", "parent_hi", "parent_lo", "conv_id")],
            parent_conv.take(pa.array(own)),
            *[pa.array(values) for values in (column["n_convs"], children[own], leaves[own], saved[own])],
        ],
        [field.split()[0] for field in LIGHT.split(", ")],
    )


def chain_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals of all chains (conv_id, parent_conv_id, top, leaves, saved), about one per shard, added to their parents."""
    held = [batch for batch in batches if len(batch)]
    if not held:
        return
    chains = pa.Table.from_batches(held)
    column = {name: chains.column(name).fill_null(-1).to_numpy() for name in chains.column_names}
    nothing = np.zeros(len(chains), np.int64)
    table = NodeTable(column["conv_id"], nothing)
    own = table.slots(column["conv_id"], nothing)
    top_chain = chains.column("parent_conv_id").is_null().to_numpy()
    up = np.where(top_chain, -1, table.slots(column["parent_conv_id"], nothing))
    by_slot = {name: np.empty(len(own), np.int64) for name in ("top", "leaves", "saved")}
    for name, values in by_slot.items():
        values[own] = column[name]
    parent = np.empty(len(own), np.int64)
    parent[own] = up
    add_to_parents(parent, by_slot["top"], by_slot["leaves"], by_slot["saved"])
    yield pa.record_batch(
        [
            chains.column("parent_conv_id").combine_chunks(),
            pa.array(column["top"] - 1),
            pa.array(by_slot["leaves"][own]),
            pa.array(by_slot["saved"][own]),
        ],
        ["conv_id", "depth", "chain_leaves", "chain_saved"],
    )


def heavy_totals(heavy: DataFrame, light: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Result rows (with hi, lo) of the heavy nodes, and of the light nodes below them.

    ``heavy`` is staged and holds the root, so all chains hang together.
    """
    up = (F.col("depth") - 1).alias("depth")
    names = heavy.select("depth", F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("above"))
    names = names.withColumn("depth", F.col("depth") + 1)
    to_parent = ["depth", "parent_hi", "parent_lo"]
    placed = heavy.join(names, to_parent, "left").withColumnRenamed("above", "parent_conv_id")
    roots = light.filter("parent_conv_id IS NULL")
    hanging = roots.groupBy(up, F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")).agg(
        F.count(F.lit(1)).alias("light_children"), F.sum("n_leaves").alias("light_leaves"), F.sum("saved_tokens").alias("light_saved")
    )
    inner = heavy.filter("depth > 0").groupBy(up, F.col("parent_hi").alias("hi"), F.col("parent_lo").alias("lo")).agg(
        F.count(F.lit(1)).alias("heavy_children")
    )
    node = ["depth", "hi", "lo"]

    def or_zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    own = stage(
        placed.join(hanging, node, "left")
        .join(inner, node, "left")
        .select(
            *node,
            "conv_id",
            "parent_conv_id",
            "n_convs",
            (or_zero("light_children") + or_zero("heavy_children")).alias("n_children"),
            # A heavy node has turns below it and is no leaf.
            or_zero("light_leaves").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("chars") + or_zero("light_saved")).alias("saved"),
        ),
        "heavy",
    )
    tops = own.filter(~F.col("parent_conv_id").eqNullSafe(F.col("conv_id"))).select("conv_id", "parent_conv_id", F.col("depth").alias("top"))
    sums = own.groupBy("conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    chains = tops.join(sums, "conv_id").select("conv_id", "parent_conv_id", "top", "leaves", "saved")
    hung = chains.coalesce(1).mapInArrow(chain_totals, "conv_id long, depth long, chain_leaves long, chain_saved long")
    hung = hung.filter("conv_id IS NOT NULL").groupBy("conv_id", "depth").agg(
        F.sum("chain_leaves").alias("chain_leaves"), F.sum("chain_saved").alias("chain_saved")
    )
    with_chains = own.join(hung, ["conv_id", "depth"], "left").withColumns(
        {
            "n_leaves": F.col("leaves") + or_zero("chain_leaves"),
            "saved_tokens": F.col("saved") + or_zero("chain_saved"),
            "height": -F.col("depth"),
        }
    )
    columns = [*node, "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    summed = running_sums(with_chains.select(*columns, "height"), "conv_id", ["height"], ["n_leaves", "saved_tokens"])
    below = light.join(names, to_parent, "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return summed.select(*columns), below.select(*columns)


def member_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hi, lo, first, ids): up to ``BLOCK`` ids of a node as comma-joined text, from rows in order."""
    for batch in batches:
        hi, lo, ids = (batch.column(name).to_numpy() for name in ("hi", "lo", "conv_id"))
        new = np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]) if len(hi) else np.zeros(0, bool)
        new[::BLOCK] = True
        first = np.flatnonzero(new)
        texts = ids.astype(str).tolist()
        joined = [",".join(texts[a:b]) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(hi)])]
        yield pa.record_batch(
            [pa.array(hi[first]), pa.array(lo[first]), pa.array(ids[first]), pa.array(joined, pa.string())],
            ["hi", "lo", "first", "ids"],
        )


def member_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hi, lo, ends_sha256) from the blocks of whole nodes, in order of ids."""
    node, sha = None, None

    def made(rows: list) -> pa.RecordBatch:
        hi, lo, hashes = zip(*rows) if rows else ((), (), ())
        return pa.record_batch(
            [pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(hashes, pa.string())], ["hi", "lo", "ends_sha256"]
        )

    for batch in batches:
        done = []
        for hi, lo, ids in zip(*(batch.column(name).to_pylist() for name in ("hi", "lo", "ids"))):
            if (hi, lo) == node:
                sha.update(b",")
            else:
                if node:
                    done.append((*node, sha.hexdigest()))
                node, sha = (hi, lo), hashlib.sha256()
            sha.update(ids.encode())
        yield made(done)
    if node:
        yield made([(*node, sha.hexdigest())])


def ends(paths: DataFrame, known: DataFrame) -> DataFrame:
    """(hi, lo, ends_sha256) of the nodes at which a conversation ends."""
    zero = F.lit(0).cast("long")
    last = paths.filter("depth = length").select("hi", "lo", "conv_id")
    last = last.union(known.filter("length = 0").select(zero, zero, "conv_id"))
    in_order = last.repartitionByRange("hi", "lo", "conv_id").sortWithinPartitions("hi", "lo", "conv_id")
    blocks = in_order.mapInArrow(member_blocks, "hi long, lo long, first long, ids string")
    met = blocks.repartition("hi", "lo").sortWithinPartitions("hi", "lo", "first")
    return met.mapInArrow(member_hashes, "hi long, lo long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    turns = stage(numbered_turns(conversations.select("conv_id", "turn", "role", "text")), "turns")
    known = stage(lengths(turns), "rebuilt")
    paths = stage(prefixes(rebuilt(turns, known)), "paths")
    nodes = stage(trie_nodes(paths, known), "nodes")
    total = nodes.filter("depth = 0").select("below").first()
    limit = max(shard_turns, (total[0] if total else 0) // MOST_SHARDS)
    is_heavy = (F.col("depth") == 0) | (F.col("below") > limit)
    # Staged, the planner knows how many they are.
    heavy = stage(nodes.filter(is_heavy).drop("below"), "top")

    node = ["depth", "hi", "lo"]
    marked = paths.select("conv_id", *node).join(heavy.select(*node, F.lit(True).alias("heavy")), node, "left")
    below = marked.filter("heavy IS NULL").groupBy("conv_id").agg(F.min("depth").alias("depth"))
    shards = paths.join(below, ["conv_id", "depth"]).select("conv_id", F.col("hi").alias("shard_hi"), F.col("lo").alias("shard_lo"))
    light = nodes.filter(~is_heavy).drop("below").join(shards, "conv_id")
    shard = ["shard_hi", "shard_lo"]
    light = stage(light.repartition(*shard).sortWithinPartitions(*shard).mapInArrow(shard_totals, LIGHT), "light")

    top, rest = heavy_totals(heavy, light)
    result = top.unionByName(rest).join(ends(paths, known), ["hi", "lo"], "left")
    return result.select(
        *["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"],
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


#: The same rows in SQL. CRC-32 goes bit by bit: one step takes in a character, eight shift it.
SQL = """
WITH RECURSIVE turns AS (
  SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
         length(coalesce(text, '')) AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS position
  FROM conversations WHERE conv_id IS NOT NULL),
crc AS (
  SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS digits, 0 AS step, CAST(4294967295 AS BIGINT) AS c FROM turns
  UNION ALL
  SELECT conv_id, digits, step + 1,
         CASE WHEN step % 9 = 0 THEN xor(c, CAST(ascii(digits[step // 9 + 1]) AS BIGINT))
              WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END
  FROM crc WHERE step < 9 * length(digits)),
known AS (
  SELECT conv_id, xor(c, CAST(4294967295 AS BIGINT)) % 6 AS h,
         least(h, (SELECT count(*) FROM turns t WHERE t.conv_id = crc.conv_id - crc.conv_id % 100)) AS borrowed
  FROM crc WHERE step = 9 * length(digits)),
rebuilt AS (
  SELECT k.conv_id, position AS depth, said, chars FROM known k
  JOIN turns t ON t.conv_id = k.conv_id - k.conv_id % 100 AND position <= h
  UNION ALL
  SELECT conv_id, borrowed + position - h, said, chars FROM known JOIN turns USING (conv_id) WHERE position > h),
listed AS (
  SELECT conv_id, coalesce(saids, []) AS saids, lens FROM known
  LEFT JOIN (SELECT conv_id, list(said ORDER BY depth) AS saids, list(chars ORDER BY depth) AS lens
             FROM rebuilt GROUP BY conv_id) USING (conv_id)),
paths AS (
  SELECT conv_id, len(saids) AS length, depth, array_to_string(saids[1:depth], ',') AS key,
         CASE WHEN depth > 0 THEN array_to_string(saids[1:depth - 1], ',') END AS parent,
         CASE WHEN depth > 0 THEN lens[depth] ELSE 0 END AS chars
  FROM (SELECT *, unnest(range(len(saids) + 1)) AS depth FROM listed)),
nodes AS (
  SELECT depth, key, any_value(parent) AS parent, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends_sha256
  FROM paths GROUP BY depth, key),
placed AS (
  SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.parent = n.key AND c.depth = n.depth + 1) AS n_children FROM nodes n),
subtrees AS (
  SELECT p.depth, p.key, count(*) FILTER (WHERE u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.chars) AS saved_tokens
  FROM placed u JOIN paths p ON p.conv_id = u.conv_id AND p.depth <= u.depth GROUP BY p.depth, p.key)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM placed n JOIN subtrees s ON s.depth = n.depth AND s.key = n.key
LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.key = n.parent
"""
