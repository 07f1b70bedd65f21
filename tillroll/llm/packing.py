"""Packing of tokenized documents into sequences of equal length.

A document is its tokens and an end token. Whole stretches of ``capacity`` tokens are
sequences of their own; the rests, each shorter, are dealt at random into groups of about
``GROUP_TOKENS`` tokens, and every group is packed on its own: first-fit decreasing, where a
tournament tree over the room of all bins finds the first bin that has room in as many
steps as the tree is deep. Then the emptiest bins of the group are cut up to fill the room
that is left in others, room under ``LEAST_PIECE`` tokens excepted, until one bin at most is
not full; a sequence whose length is a power of two needs no padding, so that bin is cut
at the powers of two in its length. So less than ``LEAST_PIECE`` tokens of a sequence are
padding, whatever the documents.

The random place of a row is its number in the task that tokenizes it, so copies of a
document, or rows of one key, meet in a group no more often than others. The pieces are
written before they are dealt out; a lost executor changes no place. A task holds one group.

Tokens come from a public vocabulary that ignores case and whose words cross neither ASCII
blanks nor a border between ASCII letters or digits and punctuation other than the
apostrophe. So each distinct word between such borders is tokenized once and remembered by
a 64-bit hash that ignores the case of A-Z; tests compare the ids with those of whole texts.
A null text counts as empty and is the end token alone. Equal rows are documents of their
own; nothing goes by the key.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.batches import small_batches
from tillroll.llm.passing import type_list
from tillroll.llm.text import NOT_BLANK, Words, joined, pieces, range_hashes
from tillroll.staging import stage

CAPACITY = 4096
END_TOKEN = 2
#: Tokens in a group; a group is what one task holds.
GROUP_TOKENS = 1 << 19
#: Room in a sequence that is worth a cut.
LEAST_PIECE = 32
#: Cells of a worker's memory of words, and words before it starts anew.
LOG_CELLS = 20
REMEMBERED = 1 << 20
#: Words that are tokenized at once.
AT_ONCE = 1 << 11


OTHER, ALNUM, PUNCT = 1, 2, 3
#: Class of every byte, 0 for blanks.
KIND = NOT_BLANK.astype(np.uint8) * OTHER
KIND[[c for c in range(128) if chr(c).isalnum()]] = ALNUM
KIND[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]] = PUNCT


def units(data: np.ndarray, bounds: np.ndarray) -> Words:
    """Words of a piece, cut also between ASCII letters or digits and punctuation."""
    kind = KIND[data]
    left, right = kind[:-1], kind[1:]
    # The border after each byte; a piece ends with a blank.
    cut = ((left == ALNUM) & (right == PUNCT)) | ((left == PUNCT) & (right == ALNUM))
    start = np.flatnonzero(right * (cut | (left == 0))) + 1
    if kind[0]:
        start = np.append(0, start)
    end = np.flatnonzero(left * (cut | (right == 0))) + 1
    return Words(start, end, range_hashes(data, start, end), np.searchsorted(start, bounds))


def extended(values: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``values`` with ``more`` after the first ``used``; room doubles."""
    if used + len(more) > len(values):
        values = np.concatenate([values[:used], np.empty(used + 2 * len(more), values.dtype)])
    values[used : used + len(more)] = more
    return values


class WordIds:
    """Token ids of words, remembered by hash. Slot 0 is the end token.

    The memory has a cell per value of the first bits of a hash; a new word takes the
    cell of an older one, and both are tokenized again where they are next met.
    """

    def __init__(self, path: str, end_token: int) -> None:
        # Spark runs a worker per core.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_token = end_token
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(1 << LOG_CELLS, np.uint64)
        self.slot_of = np.full(1 << LOG_CELLS, -1, np.int32)
        self.ids = np.array([self.end_token], np.uint32)
        # Where the ids of a slot start, and those of the next.
        self.starts = np.array([0, 1])
        self.slots_used = 1

    def learn(self, texts: list[str]) -> None:
        made: list[list[int]] = []
        for at in range(0, len(texts), AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False)
            made += [word.ids for word in found]
        ids = np.fromiter(chain.from_iterable(made), np.uint32)
        known = self.starts[self.slots_used]
        ends = known + np.cumsum(np.fromiter(map(len, made), np.int64, len(made)))
        self.ids = extended(self.ids, known, ids)
        self.starts = extended(self.starts, self.slots_used + 1, ends)
        self.slots_used += len(texts)

    def slots(self, data: np.ndarray, words: Words) -> np.ndarray:
        """Slot of every word; words not yet known are tokenized."""
        if self.slots_used > REMEMBERED:
            self.forget()
        cell = (words.hashes >> np.uint64(64 - LOG_CELLS)).astype(np.int64)
        slot = np.where(self.hashes[cell] == words.hashes, self.slot_of[cell], -1).astype(np.int64)
        unknown = np.flatnonzero(slot < 0)
        if len(unknown):
            _, first, same = np.unique(words.hashes[unknown], return_index=True, return_inverse=True)
            at = unknown[first]
            new = self.slots_used + np.arange(len(at))
            self.learn([data[a:b].tobytes().decode() for a, b in zip(words.start[at].tolist(), words.end[at].tolist())])
            slot[unknown] = new[same]
            self.hashes[cell[at]], self.slot_of[cell[at]] = words.hashes[at], new
        return slot

    def token_ids(self, data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with its end token, and tokens per text."""
        slots = np.insert(self.slots(data, words), words.bounds[1:], 0)
        starts = self.starts[slots]
        sizes = self.starts[slots + 1] - starts
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)
        last = words.bounds[1:] + np.arange(len(words.bounds) - 1)
        return self.ids[at], np.diff(ends[last], prepend=0)


@cache
def word_ids(path: str, end_token: int) -> WordIds:
    """One per Python worker."""
    return WordIds(path, end_token)


PIECES = "start long, length long, doc_tokens long, ids binary, seat long"


def token_pieces(rows: DataFrame, path: str, capacity: int, end_token: int) -> DataFrame:
    """Whole stretches and the rest of every row (_kept, text); ``seat`` numbers all pieces.

    The ids of a whole stretch are 32-bit integers. Those of a rest, which is dealt out yet,
    take 16 bits each if the vocabulary allows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = word_ids(path, end_token)
        narrow = np.uint16 if max(known.tokenizer.get_vocab_size(), end_token + 1) <= 1 << 16 else np.uint32
        seat = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in pieces(batch):
                data, bounds = joined(piece.column("text"))
                ids, n = known.token_ids(data, units(data, bounds))
                n_pieces = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), n_pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)) * capacity
                length = np.minimum(n[row] - start, capacity)
                ends = np.cumsum(length)
                packed = [
                    ids[a:b].astype(narrow if b - a < capacity else np.uint32).tobytes()
                    for a, b in zip((ends - length).tolist(), ends.tolist())
                ]
                yield pa.record_batch(
                    [
                        piece.column("_kept").take(pa.array(row)),
                        *[pa.array(values) for values in (start, length, n[row])],
                        pa.array(packed, pa.binary()),
                        pa.array(seat + np.arange(len(row))),
                    ],
                    ["_kept", "start", "length", "doc_tokens", "ids", "seat"],
                )
                seat += len(row)

    return rows.mapInArrow(cut, f"{type_list(rows, ['_kept'])}, {PIECES}")


def first_fit(lengths: list[int], capacity: int) -> list[int]:
    """Bin of every item, each put into the first bin that has room for it.

    The leaves of a tournament tree are the room of all bins, unopened ones included, and
    every inner node the larger of its two; two bins are never both half empty, which
    bounds the bins.
    """
    bins = 2 * -(-sum(lengths) // capacity) + 1
    leaves = 1 << (bins - 1).bit_length()
    room = [capacity] * (2 * leaves)
    found = []
    for length in lengths:
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < length:
                at += 1
        found.append(at - leaves)
        room[at] -= length
        while at > 1:
            at //= 2
            most = max(room[2 * at], room[2 * at + 1])
            if room[at] == most:
                break
            room[at] = most
    return found


Piece = tuple[int, int, int]  # item, start within the item, length


def pack(lengths: list[int], capacity: int = CAPACITY, least_piece: int = LEAST_PIECE) -> list[list[Piece]]:
    """Pieces of each sequence, for items in descending order of length, none above ``capacity``."""
    bins: dict[int, list[Piece]] = {}
    for item, place in enumerate(first_fit(lengths, capacity)):
        bins.setdefault(place, []).append((item, 0, lengths[item]))
    sequences = sorted(bins.values(), key=lambda pieces: -sum(piece[2] for piece in pieces))
    filled = [sum(piece[2] for piece in pieces) for pieces in sequences]
    full, last = 0, len(sequences) - 1
    while full < last:
        room = capacity - filled[full]
        if room < least_piece:
            full += 1
            continue
        item, start, length = sequences[last].pop()
        taken = min(length, room)
        if taken < length:
            sequences[last].append((item, start, length - taken))
        sequences[full].append((item, start + length - taken, taken))
        filled[full] += taken
        filled[last] -= taken
        if not filled[last]:
            sequences.pop()
            last -= 1
    if sequences and capacity - filled[last] >= least_piece:
        sequences[last:] = powers_of_two(sequences[last])
    return sequences


def powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """The pieces of one sequence, cut into sequences whose lengths are powers of two."""
    left, made = list(reversed(pieces)), []
    total = sum(piece[2] for piece in pieces)
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        made.append([])
        while room:
            item, start, length = left.pop()
            taken = min(length, room)
            made[-1].append((item, start, taken))
            room -= taken
            if taken < length:
                left.append((item, start + taken, length - taken))
    return made


def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Sorted batches as one table per value of ``key``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            if held and held[0].column(key)[0].as_py() != keys[a]:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def pack_groups(capacity: int, least_piece: int):
    """Packed pieces of whole groups, from rows in order of group and descending length."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, "group"):
            starts, group = table.column("start").to_numpy(), table.column("group")[0].as_py()
            lengths = table.column("length").to_pylist()
            made = pack(lengths, capacity, least_piece)
            ids = [
                np.frombuffer(data, np.uint16 if len(data) == 2 * n else np.uint32)
                for data, n in zip(table.column("ids").to_pylist(), lengths)
            ]
            of_bin = np.repeat(np.arange(len(made)), [len(pieces) for pieces in made])
            item, start, length = np.array([piece for pieces in made for piece in pieces], np.int64).T
            before = np.cumsum(length) - length
            first = np.concatenate([[True], of_bin[1:] != of_bin[:-1]])
            offset = before - np.maximum.accumulate(np.where(first, before, 0))
            rows = table.select(["_kept", "doc_tokens"]).take(pa.array(item)).combine_chunks()
            cut = [
                ids[i][a : a + n].astype(np.uint32).tobytes() for i, a, n in zip(item.tolist(), start.tolist(), length.tolist())
            ]
            yield pa.record_batch(
                [
                    *[rows.column(name).combine_chunks() for name in rows.column_names],
                    pa.array(starts[item] + start),
                    pa.array(length),
                    pa.array(((group << 20) + of_bin) * 2),
                    pa.array(offset),
                    pa.array(cut, pa.binary()),
                ],
                ["_kept", *PACKED],
            )

    return packed


PACKED = ["doc_tokens", "start", "length", "sequence_id", "offset", "ids"]


def pack_documents(
    docs: DataFrame,
    columns: list[str],
    tokenizer: str,
    text: str = "text",
    capacity: int = CAPACITY,
    end_token: int = END_TOKEN,
    group_tokens: int = GROUP_TOKENS,
    least_piece: int = LEAST_PIECE,
) -> DataFrame:
    """One row per piece: ``columns`` of its document, doc_tokens, start, length, sequence_id, offset, ids.

    ``tokenizer`` is the path of a vocabulary file that every executor has. ``ids`` are
    little-endian 32-bit integers. ``columns`` must not hold the names above.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*columns).alias("_kept"), F.col(text).alias("text"))
    made = stage(token_pieces(rows, tokenizer, capacity, end_token), "pieces")
    rests = made.filter(F.col("length") < capacity)
    tokens = rests.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // group_tokens))
    dealt = rests.withColumn("group", F.pmod(F.xxhash64("seat"), F.lit(groups))).drop("seat")
    met = dealt.repartition("group").sortWithinPartitions("group", F.desc("length"))
    schema = f"{type_list(made, ['_kept'])}, doc_tokens long, start long, length long, sequence_id long, offset long, ids binary"
    packed = met.mapInArrow(pack_groups(capacity, least_piece), schema)
    alone = made.filter(F.col("length") == capacity).select(
        "_kept", "doc_tokens", "start", "length", (F.col("seat") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids"
    )
    return packed.unionByName(alone).select("_kept.*", *PACKED)


def packed_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    return pack_documents(docs, ["doc_id"], tokenizer).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
