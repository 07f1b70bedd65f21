"""Prefix trie, packing and fill-in-the-middle against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import connect, difference
from tillroll.llm import fill_middle, packing, prefix_trie
from tillroll.llm.registry import LLM_QUERIES, LLM_SQL

SMALL = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_against_sql(spark, name):
    assert difference(LLM_QUERIES[name](spark, SMALL), connect(SMALL), LLM_SQL[name]) is None


# Prefix trie


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def trie(rows):
    """Nodes of the rebuilt conversations, turn by turn."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            turns[conv_id].append((turn is not None, turn or 0, role, sha(f"{len(role)}:{role}{text}"), text))
    own = {c: [(t[2], t[4]) for t in sorted(found)] for c, found in turns.items()}
    paths = {}
    for c, said in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        paths[c] = own.get(c - c % 100, [])[:h] + said[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
            if d:
                children[tuple(path[: d - 1])].add(tuple(path[:d]))
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted(
        (
            found[0],
            len(node),
            members[node[:-1]][0] if node else None,
            len(found),
            len(children[node]),
            leaves[node],
            saved[node],
            sha(",".join(str(c) for c in found if len(paths[c]) == len(node))),
        )
        for node, found in members.items()
    )


def found_trie(spark, rows, **options):
    result = prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS), **options).collect()
    return sorted(tuple(row) for row in result)


@pytest.mark.parametrize("shard_turns", [0, 3, 1000])
def test_trie_of_many_shapes(spark, sliced, shard_turns):
    draw = random.Random(1)
    rows = []
    for c in range(90, 330):
        for turn in range(draw.randrange(1, 9)):
            rows.append((c, turn, draw.choice(["user", "bot", None]), draw.choice(["hi", "", None, "é𝄞", "go on"])))
    # A conversation with a third of all rows, copies of a turn, and turns of no conversation.
    rows += [(400, turn // 2, "user", str(turn % 7)) for turn in range(500)]
    rows += [(401, None, None, None)] * 3 + [(401, 5, "user", "x")] * 2 + [(None, 1, "user", "lost")] * 2
    draw.shuffle(rows)
    assert found_trie(spark, rows, shard_turns=shard_turns) == trie(rows)


def test_trie_of_copies_and_beginnings(spark, sliced, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 4)
    rows = [(c, t, "user", str(t)) for c in range(1000, 1060) for t in range(12)]
    rows += [(2000 + k, t, "user", f"deep {t}") for k in range(30) for t in range(k + 1)]
    rows += [(3000, None, "user", "again")] * 30
    for shard_turns in (0, 20):
        assert found_trie(spark, rows, shard_turns=shard_turns) == trie(rows)


def test_trie_of_nothing_and_of_other_columns(spark):
    assert found_trie(spark, []) == []
    clashing = spark.createDataFrame([(1, 0, "user", "a", 9, 9)], TURNS + ", hi long, depth long")
    assert prefix_trie.prefix_trie(clashing).count() == len(trie([(1, 0, "user", "a")]))


def test_node_table_is_minimal_and_perfect():
    draw = np.random.default_rng(0)
    hi, lo = draw.integers(-(1 << 62), 1 << 62, (2, 5000))
    hi[:100] = 7
    table = prefix_trie.NodeTable(hi, lo)
    assert sorted(table.slots(hi, lo)) == list(range(5000))
    assert (table.slots(hi + 1, lo) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.NodeTable(np.array([1, 1]), np.array([2, 2]))


# Packing


def padding(lengths, capacity):
    return sum(capacity - n for n in lengths if n & (n - 1))


def packed(docs, **options):
    return packing.pack_documents(docs, ["doc_id"], VOCABULARY, **options).collect()


def check_packed(docs, rows, capacity=packing.CAPACITY):
    """Every token is in one piece, pieces of a sequence follow each other, ids are the tokenizer's."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for row in rows:
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert len(ids) == row.length > 0
        pieces[row.doc_id].append((row.start, ids, row.doc_tokens))
        sequences[row.sequence_id].append((row.offset, row.length))
    expected, found = defaultdict(list), defaultdict(list)
    for doc in docs.select("doc_id", "text").collect():
        expected[doc.doc_id].append(tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [2])
    for doc_id, own in pieces.items():
        starts = defaultdict(list)
        for start, ids, n in own:
            starts[n].append((start, ids))
        for n, parts in starts.items():
            whole = defaultdict(list)
            for start, ids in sorted(parts):
                open_ = next(k for k in range(len(parts)) if sum(map(len, whole[k])) == start)
                whole[open_].append(ids)
            found[doc_id] += [sum(ids, []) for ids in whole.values() if ids]
    if all(len(texts) == 1 for texts in expected.values()):
        assert found == expected
    lengths = []
    for parts in sequences.values():
        parts.sort()
        assert [offset for offset, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        lengths.append(sum(n for _, n in parts))
    assert max(lengths) <= capacity
    assert sum(lengths) == sum(len(ids) for texts in expected.values() for ids in texts)
    return lengths


def test_packing_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packed(docs)
    lengths = check_packed(docs, rows)
    assert padding(lengths, 4096) < 0.008 * sum(lengths)
    assert rows and sorted(packed(docs)) == sorted(rows)


def test_packing_of_odd_texts(spark, documents):
    texts = [None, "", " \t\n", "a", "it's, i'm 3.5% <b>≠</b> “x”—y, é, ≮", "日本語 text, ÀÉ", "x" * 9000, "go " * 5000, "a,b." * 3000]
    texts += ["same text, twice"] * 40
    docs = documents(*texts)
    for options in ({}, {"group_tokens": 500}, {"capacity": 64, "least_piece": 8}):
        capacity = options.get("capacity", 4096)
        lengths = check_packed(docs, packed(docs, **options), capacity)
        slack = options.get("least_piece", packing.LEAST_PIECE)
        assert all(capacity - n < slack or not n & (n - 1) for n in lengths)
    assert packed(docs.limit(0)) == []
    one_id = docs.withColumn("doc_id", F.lit(None).cast("long"))
    check_packed(one_id, packed(one_id))
    clashing = docs.selectExpr("doc_id", "text", "1 AS seat", "2 AS `group`")
    made = packing.pack_documents(clashing, ["doc_id", "seat", "group"], VOCABULARY)
    assert {(row.seat, row.group) for row in made.collect()} == {(1, 2)}


def first_fit(lengths, capacity):
    room, found = [], []
    for n in lengths:
        place = next((i for i, free in enumerate(room) if free >= n), len(room))
        room[place:] = room[place:] or [capacity]
        room[place] -= n
        found.append(place)
    return found


def test_first_fit_of_the_tournament_tree():
    draw = random.Random(2)
    for capacity in (7, 100, 4096):
        for n in (0, 1, 5, 300):
            lengths = sorted((draw.randint(1, capacity) for _ in range(n)), reverse=True)
            assert packing.first_fit(lengths, capacity) == first_fit(lengths, capacity)


def test_memory_of_words_is_bounded(monkeypatch):
    texts = [f"word{i} and, more{i % 7}" for i in range(400)]
    whole = [Tokenizer.from_file(VOCABULARY).encode(text, add_special_tokens=False).ids + [2] for text in texts]
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    monkeypatch.setattr(packing, "LOG_CELLS", 4)
    known = packing.WordIds(VOCABULARY, 2)
    for at in range(0, 400, 40):
        data, bounds = packing.joined(packing.pa.array(texts[at : at + 40], packing.pa.large_string()))
        ids, n = known.token_ids(data, packing.units(data, bounds))
        assert [part.tolist() for part in np.split(ids, np.cumsum(n)[:-1])] == whole[at : at + 40]
        assert known.slots_used < 50 + 3 * 120


# Fill-in-the-middle


TOKEN = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def cut(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digits = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (n, "plain", None, None, text)
    if h[3] % 100 < 80:
        return (n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}")
    return (n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}")


def test_cuts_of_odd_texts(spark, documents):
    kinds = [None, "", " ", "\n\t x", "x ", "one two  three\n\n four ", "a <P> b", "<M>", "<", "é 𝄞 x y　z <S", "w " * 3000, "y" * 5000]
    texts = kinds * 30
    docs = documents(*texts).withColumn("n", F.lit("own"))
    made = fill_middle.fill_in_middle(docs, ["doc_id", "text"])
    made = made.withColumn("again", fill_middle.restored(F.col("output"), F.col("form")))
    forms = set()
    for row in made.collect():
        assert (row.n, row.form, row.prefix_chars, row.middle_chars, row.output) == cut(row.doc_id, row.text)
        assert row.again == (row.text or "")
        forms.add(row.form)
    assert forms == {"plain", "psm", "spm"} and made.count() == len(texts)
    no_id = fill_middle.fill_in_middle(docs.withColumn("doc_id", F.lit(None).cast("long")), ["text"], rate=100)
    assert no_id.filter("text IS NOT NULL").first() and fill_middle.digests(docs.limit(0)).count() == 0


def test_learned_index_is_exact():
    draw = np.random.default_rng(3)
    for steps in (np.ones(1), draw.integers(1, 9, 5000), draw.integers(1, 9, 3000) ** 6, np.repeat([1, 100000], 1500)):
        values = np.cumsum(steps)
        index = fill_middle.fit(values)
        assert (index.values(np.arange(len(values))) == values).all()
        assert index.residuals.dtype == np.int8
    # Text of even tokens needs few segments.
    assert len(fill_middle.fit(np.arange(0, 60000, 6)).first) == 10
