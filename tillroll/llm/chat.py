"""Chat formatting: roles of transcript lines by a hidden Markov model, canonical turns.

A conversation is a sequence of rows in the order of their turn; the lines of each row's
text are the observations. A state is a role and whether the line starts a turn. A line is
observed as four features: the role that a speaker marker names ("User:", "### Assistant",
"<|im_start|>system", "Q:" ...) or none, whether the row starts here, a length class (of
the whole row for its first line), and its form (question, list, code, plain).

Start, transition and emission counts come from conversations whose rows have a role, in a
bounded sample (``SAMPLE`` conversations, chosen by a hash); smoothing covers the rest.
Markers have fixed probabilities that outweigh everything else, as they name the role.

Viterbi runs over whole conversations of any length without one task per conversation:
rows are cut into blocks of ``BLOCK`` rows; each block is reduced to the best score from
every entry state to every exit state, the blocks of a conversation are chained by these
small matrices, and every block then recovers its own path between the states found for
its ends. Consecutive lines of one role are a turn. Every row gives its part of the
rendering: the turn's header before a line that begins a turn, the line without its
marker, and the end mark before the next turn, so that the parts of a conversation, one
after the other, are its canonical form.

Null texts are empty lines. Rows with the same conversation and turn are ordered by their
text. Rows without a conversation id form one conversation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.vectors import add_up, packed
from tillroll.staging import stage

# Canonical roles, and the marker words that name them.
ROLES = ["system", "user", "assistant", "tool"]
MARKERS = {
    "system": "system instruction instructions context prompt".split(),
    "user": "user human question q customer client student me prompter instructor".split(),
    "assistant": "assistant ai bot answer a agent model gpt response chatgpt teacher".split(),
    "tool": "tool function observation result output".split(),
}
ROLE_OF = {word: role for role in ROLES for word in MARKERS[role]}
MARKER = re.compile(
    r"^\s*(?:<\|(?:im_start|start_header_id)?\|?>?\s*|\[|<|#{1,6}\s*|\*\*)?\s*(?P<word>[A-Za-z]+)\s*"
    r"(?P<end>(?:<\|end_header_id\|>|\|>|\]|>|\*\*)?\s*:(?:\*\*)?|<\|end_header_id\|>|\|>|\]:?|>:?|\*\*:?)\s*"
)
HEADING = re.compile(r"^\s*(?:#{1,6}\s*|<\|im_start\|>\s*)(?P<word>[A-Za-z]+)\s*$")
END_MARK = re.compile(r"\s*(?:<\|im_end\|>|<\|eot_id\|>|</s>)\s*$")

STATES = 2 * len(ROLES)  # role * 2 + whether the line starts a turn
FORMS = 4
LENGTHS = 4
LINE_LENGTHS = (20, 120, 600)
ROW_LENGTHS = (50, 400, 2000)
SYMBOLS = (len(ROLES) + 1) * 2 * LENGTHS * FORMS
SAMPLE = 20_000
BLOCK = 512
SMOOTHING = 0.5
#: Share of turns that start with a marker, and the chance of one that names another role.
MARKED = 0.05
UNFIT = 1e-9


def marked(line: str) -> tuple[int | None, str]:
    """Role number that a marker at the start of the line names, and the rest of the line."""
    for pattern in (MARKER, HEADING):
        found = pattern.match(line)
        if found and found["word"].lower() in ROLE_OF:
            return ROLES.index(ROLE_OF[found["word"].lower()]), line[found.end() :]
    return None, line


def observed(text: str | None) -> list[tuple[int, str]]:
    """(symbol, content) of every line of a row."""
    out = []
    for i, raw in enumerate((text or "").split("\n")):
        role, line = marked(END_MARK.sub("", raw))
        bare = line.strip()
        if bare.endswith(("?", "？")):
            form = 1
        elif bare[:2] in ("- ", "* ") or bare[:1].isdigit():
            form = 2
        elif bare.startswith(("```", "    ")) or bare.endswith((";", "{", "}")):
            form = 3
        else:
            form = 0
        # The first line of a row stands for the whole row.
        size, limits = (len(text or ""), ROW_LENGTHS) if i == 0 else (len(bare), LINE_LENGTHS)
        length = sum(size > limit for limit in limits)
        symbol = len(ROLES) if role is None else role
        out.append((((symbol * 2 + (i == 0)) * LENGTHS + length) * FORMS + form, line))
    return out


def marker_of(symbols: np.ndarray) -> np.ndarray:
    return symbols // (2 * LENGTHS * FORMS)


@dataclass
class ChatModel:
    """Log-probabilities: first state, state to state, and state to symbol."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def roles_of(rows: DataFrame) -> DataFrame:
    """Role numbers of rows with a known role name, in any case; others null."""
    known = F.create_map(*[F.lit(x) for i, role in enumerate(ROLES) for x in (role, i)])
    return rows.withColumn("known", known[F.lower("role")])


def model_of(counts: np.ndarray) -> ChatModel:
    start = counts[:STATES]
    step = counts[STATES : STATES + STATES * STATES].reshape(STATES, STATES)
    emit = counts[STATES + STATES * STATES :].reshape(STATES, SYMBOLS)
    begins = np.arange(STATES) % 2 == 1
    # A conversation starts with a turn, and a turn goes on only in its own role.
    start_mass = (start + SMOOTHING) * begins
    allowed = begins[None, :] | (np.arange(STATES)[:, None] // 2 == np.arange(STATES)[None, :] // 2)
    step_mass = (step + SMOOTHING) * allowed
    named = marker_of(np.arange(SYMBOLS)) < len(ROLES)
    fits = (marker_of(np.arange(SYMBOLS))[None, :] == np.arange(STATES)[:, None] // 2) & begins[:, None]
    plain = (emit + SMOOTHING) * ~named[None, :]
    plain /= plain.sum(axis=1, keepdims=True)
    share = np.where(fits.any(axis=1), MARKED, 0.0)[:, None]
    emit = np.where(named[None, :], np.where(fits, share / max(fits[1].sum(), 1), UNFIT), (1 - share) * plain)
    with np.errstate(divide="ignore"):
        return ChatModel(
            np.log(start_mass / start_mass.sum()),
            np.log(step_mass / step_mass.sum(axis=1, keepdims=True)),
            np.log(emit / emit.sum(axis=1, keepdims=True)),
        )


def in_blocks(conversations: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with ``conv``, their ``rank`` in it from 0, and the number of their ``block``.

    Ranks need an order within a conversation. One of any length is first cut into ranges
    of its turns, whose row counts give each range its offset.
    """
    rows = conversations.withColumn("conv", F.col("conv_id").cast("long"))
    rows = rows.withColumn("part", F.floor(F.coalesce(F.col("turn"), F.lit(-1)) / F.lit(BLOCK)).cast("long"))
    counts = rows.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("conv").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset")
    )
    placed = rows.join(offsets, F.col("conv").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).drop("c", "p")
    within = Window.partitionBy("conv", "part").orderBy(F.col("turn").asc_nulls_first(), "text", *columns)
    placed = placed.withColumn("rank", F.col("offset") + F.row_number().over(within) - 1)
    return placed.withColumn("block", F.floor(F.col("rank") / BLOCK)).drop("offset", "part")


def learn(rows: DataFrame, sample: int = SAMPLE) -> ChatModel:
    """Counts of the sample's rows (conv, rank, text, known); rows without a role teach nothing."""
    n = rows.select("conv").distinct().count()
    chance = F.xxhash64(F.lit("chat"), "conv") / float(1 << 64) + 0.5
    chosen = rows.filter((chance <= F.lit(min(1.0, sample / max(n, 1)))) & F.col("known").isNotNull())
    before = F.lag(F.struct("known", "rank")).over(Window.partitionBy("conv", "block").orderBy("rank"))
    chosen = chosen.withColumn("before", F.when(before["rank"] == F.col("rank") - 1, before["known"]))
    size = STATES + STATES * STATES + STATES * SYMBOLS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for text, role, previous, rank in zip(*(batch.column(c).to_pylist() for c in ("text", "known", "before", "rank"))):
                for i, (symbol, _) in enumerate(observed(text)):
                    state = role * 2 + (i == 0)
                    total[STATES + STATES * STATES + state * SYMBOLS + symbol] += 1
                    if i:
                        total[STATES + (role * 2 + (i == 1)) * STATES + state] += 1
                    elif rank == 0:
                        total[state] += 1
                    elif previous is not None:
                        # Where in the earlier row the turn stood does not matter: count both.
                        total[STATES + previous * 2 * STATES + state] += 0.5
                        total[STATES + (previous * 2 + 1) * STATES + state] += 0.5
        yield pa.record_batch([pa.array([packed(total)], pa.binary())], ["counts"])

    counted = chosen.select("text", "known", "before", "rank").mapInArrow(count, "counts binary")
    return model_of(add_up(counted, "counts", size, np.float64))


def advance(model: ChatModel, scores: np.ndarray, symbol: int) -> tuple[np.ndarray, np.ndarray]:
    """Scores after one more line, from every entry (rows), and the best state before."""
    ways = scores[:, :, None] + model.step[None, :, :]
    return ways.max(axis=1) + model.emit[:, symbol], ways.argmax(axis=1)


def blocks(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[tuple]]]:
    """(key of the first two columns, rows) of every block of sorted rows."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row)
    if rows:
        yield key, rows


def block_matrices(model: ChatModel):
    """(conv, block, m): best score from each state before the block to each state at its end."""

    def reduce_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (conv, block), rows in blocks(batches, ["conv", "block", "rank", "text"]):
            scores = None
            for row in rows:
                for symbol, _ in observed(row[3]):
                    if scores is None and block == 0:
                        scores = np.repeat((model.start + model.emit[:, symbol])[None, :], STATES, axis=0)
                    elif scores is None:
                        scores = model.step + model.emit[:, symbol]
                    else:
                        scores, _ = advance(model, scores, symbol)
            yield pa.record_batch(
                [pa.array([conv], pa.int64()), pa.array([block], pa.int64()), pa.array([scores.ravel().tolist()], pa.list_(pa.float64()))],
                ["conv", "block", "m"],
            )

    return reduce_blocks


def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, block, entry, exit) of the best path through each conversation's sorted blocks."""

    def path(conv: int, matrices: list[np.ndarray]) -> pa.RecordBatch:
        scores, back = matrices[0][0], []
        for matrix in matrices[1:]:
            ways = scores[:, None] + matrix
            back.append(ways.argmax(axis=0))
            scores = ways.max(axis=0)
        exits = [int(scores.argmax())]
        for before in reversed(back):
            exits.append(int(before[exits[-1]]))
        exits.reverse()
        n = len(exits)
        return pa.record_batch(
            [pa.array([conv] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array([-1, *exits[:-1]], pa.int64()), pa.array(exits, pa.int64())],
            ["c", "b", "entry", "exit"],
        )

    current, matrices = (), []
    for batch in batches:
        for conv, matrix in zip(batch.column("conv").to_pylist(), batch.column("m").to_pylist()):
            if (conv,) != current:
                if matrices:
                    yield path(current[0], matrices)
                current, matrices = (conv,), []
            matrices.append(np.array(matrix).reshape(STATES, STATES))
    if matrices:
        yield path(current[0], matrices)


RENDERED = "conv_id long, turn long, role string, lines int, rendered string"


def decode(model: ChatModel):
    """Roles and rendering of the rows of every block, between its entry and exit states."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "block", "rank", "turn", "text", "entry", "exit"]
        for (conv, _), rows in blocks(batches, names):
            lines = [(i, symbol, content) for i, row in enumerate(rows) for symbol, content in observed(row[4])]
            entry, state = rows[0][5], rows[0][6]
            first = model.start if entry < 0 else model.step[entry]
            scores, back = (first + model.emit[:, lines[0][1]])[None, :], []
            for _, symbol, _ in lines[1:]:
                scores, before = advance(model, scores, symbol)
                back.append(before[0])
            states = [state]
            for before in reversed(back):
                states.append(int(before[states[-1]]))
            states.reverse()
            previous = -1 if entry < 0 else entry // 2
            parts: list[list[str]] = [[] for _ in rows]
            roles: list[list[int]] = [[] for _ in rows]
            for (i, _, content), here in zip(lines, states):
                # Neighbouring lines of a role are one turn, also where a marker repeats.
                if here // 2 != previous:
                    parts[i].append(("" if previous < 0 else "<|end|>\n") + f"<|{ROLES[here // 2]}|>")
                parts[i].append(content.strip() if here % 2 else content.rstrip())
                roles[i].append(here // 2)
                previous = here // 2
            yield pa.record_batch(
                [
                    pa.array([conv] * len(rows), pa.int64()),
                    pa.array([row[3] for row in rows], pa.int64()),
                    pa.array([ROLES[own[0]] for own in roles], pa.string()),
                    pa.array([len(own) for own in roles], pa.int32()),
                    pa.array(["\n".join(part) for part in parts], pa.string()),
                ],
                ["conv_id", "turn", "role", "lines", "rendered"],
            )

    return run


def format_chats(conversations: DataFrame, model: ChatModel | None = None) -> DataFrame:
    """(conv_id, turn, role, lines, rendered) of every row.

    ``role`` is that of the row's first line, found without looking at the row's own role
    column, which only teaches the model if none is given.
    """
    columns = ["conv_id", "turn", "role", "text"]
    rows = roles_of(conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    rows = stage(in_blocks(rows, columns).select("conv", "block", "rank", "turn", "text", "known"), "chat-rows")
    model = model or learn(rows)
    order = ["conv", "block", "rank"]
    sorted_rows = rows.repartition("conv", "block").sortWithinPartitions(*order)
    matrices = sorted_rows.select("conv", "block", "rank", "text").mapInArrow(block_matrices(model), "conv long, block long, m array<double>")
    chained = matrices.repartition("conv").sortWithinPartitions("conv", "block")
    ends = chained.mapInArrow(chain, "c long, b long, entry long, exit long")
    met = rows.join(ends, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")))
    met = met.repartition("conv", "block").sortWithinPartitions(*order)
    return met.select("conv", "block", "rank", "turn", "text", "entry", "exit").mapInArrow(decode(model), RENDERED)
