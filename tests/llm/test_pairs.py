"""N-gram join, sentence dedup, decontamination and fingerprints against brute force."""

import hashlib
import random

import numpy as np
from llm_helpers import components_of, shingles, words

from tillroll.llm import decontamination, fingerprints, ngram_join, sentences
from tillroll.llm.components import components


def prose(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**{i: 100 for i in range(100, 141)}, **{i: 1 for i in range(1, 30)}}


def test_join_equals_brute_force_on_edited_copies(spark, documents):
    rng = random.Random(1)
    base = prose(rng, 200)
    texts = []
    for _ in range(60):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [" ".join(prose(rng, rng.randrange(1, 60))) for _ in range(40)]
    texts += [None, "", " \n", "one", "ONE", "one two", "É é", "é É", " ".join(base).upper(), texts[0]]
    rows = ngram_join.similarity_components(documents(*texts)).collect()
    expected = components_of({i: shingles(text) for i, text in enumerate(texts)})
    assert {row.doc_id: row.component_id for row in rows} == expected
    assert {row.doc_id: row.n_shingles for row in rows} == {i: len(shingles(text)) for i, text in enumerate(texts)}


def test_join_of_given_documents(small):
    rows = ngram_join.similarity_components(small).collect()
    expected = components_of({row.doc_id: shingles(row.text) for row in small.collect()})
    assert {row.doc_id: row.component_id for row in rows} == expected


def test_join_of_nothing_and_of_missing_or_repeated_ids(spark, documents):
    assert ngram_join.similarity_components(documents().limit(0)).count() == 0
    docs = documents("a b c", "a b c", "d", "e", ids=[5, None, 9, 9])
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in ngram_join.similarity_components(docs).collect())
    # A missing id comes before all others, so it names the component, as nothing.
    assert found == [("5", 1, "None"), ("9", 1, "9"), ("9", 1, "9"), ("None", 1, "None")]


def test_one_row_per_group_stays_with_its_extra_columns(documents):
    docs = documents("a b c", "a b c", "z", "z", ids=[2, 1, 7, 7]).selectExpr("*", "1 AS id", "2 AS component", "3 AS n")
    kept = ngram_join.without_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(row.doc_id for row in kept.collect()) == [1, 7]


def test_texts_that_share_an_id_or_have_none_are_documents_of_their_own(documents):
    docs = documents("x y z", "p q r", "X y z", "p q r", "own", "other", "own", None, "", ids=[None, None, 1, 2, 7, 7, 7, None, None])
    kept = ngram_join.without_near_duplicates(docs).collect()
    found = sorted((str(row.doc_id), str(row.text)) for row in kept)
    assert found == [("7", "other"), ("7", "own"), ("None", ""), ("None", "None"), ("None", "p q r"), ("None", "x y z")]


def test_repeated_passages_are_cut_from_later_documents(documents):
    rng = random.Random(2)
    passage = ". ".join(" ".join(prose(rng, 9)) for _ in range(7)) + "."
    plain = " ".join(prose(rng, 60))
    start, end = " ".join(prose(rng, 12)) + ". ", " " + " ".join(prose(rng, 12)) + "."
    texts = [start + passage, "Own words here. " + passage + end, plain, "Zürich ist groß. " + plain, None, "", "Short.", "Short."]
    spans = sentences.removed_spans(documents(*texts)).collect()
    assert {(row.doc_id, row.first_id) for row in spans} == {(1, 0), (3, 2)}
    for row in spans:
        assert texts[row.doc_id][row.start : row.stop] == row.removed_text
    kept = {row.doc_id: row for row in sentences.without_repeats(documents(*texts)).collect()}
    assert kept[0].text == texts[0] and kept[4].text is None and [kept[i].text for i in (5, 6, 7)] == ["", "Short.", "Short."]
    assert kept[1].text.startswith("Own words here. ") and kept[1].text.endswith(end) and kept[1].n_chars == len(kept[1].text)
    # What is left of a passage of more than 50 words has fewer words than a run.
    assert len(set(words(passage)) & set(words(kept[1].text))) < sentences.LEAST_WORDS
    assert kept[3].text.startswith("Zürich ist groß.") and len(words(kept[3].text)) < 30


def test_no_long_passage_stays_repeated(small):
    """No window of 50 words is left in two documents; nothing else is lost."""
    seen = {}
    cut = {row.doc_id: row.text for row in sentences.without_repeats(small).collect()}
    for doc_id, text in cut.items():
        own = words(text)
        for i in range(len(own) - 49):
            assert seen.setdefault(tuple(own[i : i + 50]), doc_id) == doc_id
    before = {row.doc_id: row.text for row in small.collect()}
    removed = sum(row.stop - row.start for row in sentences.removed_spans(small).collect())
    assert sum(map(len, before.values())) - sum(map(len, cut.values())) == removed


def test_emptied_and_repeated_rows_and_extra_columns(documents):
    rng = random.Random(3)
    text = " ".join(prose(rng, 80)) + "."
    docs = documents(text, text, text, ids=[1, 2, 2]).selectExpr("*", "1 AS id", "2 AS removed", "3 AS spans", "4 AS `row`")
    kept = sentences.without_repeats(docs)
    assert kept.columns == docs.columns and [row.doc_id for row in kept.collect()] == [1]
    assert sentences.without_repeats(docs.limit(0)).count() == 0 and sentences.removed_spans(docs.limit(0)).count() == 0


def test_only_runs_that_may_be_repeated_are_written_with_their_place(documents, monkeypatch):
    rng = random.Random(5)
    sentence = lambda: " ".join(prose(rng, 9)) + ". "
    passage = "".join(sentence() for _ in range(4))
    staged, stage = {}, sentences.stage
    monkeypatch.setattr(sentences, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    docs = documents(*["".join(sentence() for _ in range(20)) + passage + sentence() for _ in range(3)])
    cut = {row.doc_id: row.text for row in sentences.without_repeats(docs).collect()}
    assert passage in cut[0] and passage not in cut[1] and passage not in cut[2]
    # Four sentences have two runs of three, in each of three documents.
    assert staged["found"].count() == 6 and staged["found"].select("h").distinct().count() == 2


def test_different_texts_under_one_id_or_without_id_are_cut_on_their_own(documents):
    rng = random.Random(4)
    sentence = lambda: " ".join(prose(rng, 9)) + ". "
    passage = "".join(sentence() for _ in range(5))
    own, short = ["".join(sentence() for _ in range(9)) for _ in range(4)], "Only one here."
    # The passage ends the texts of id 2, and starts both texts without id, at the same place.
    texts = [passage + own[0], own[1] + passage, own[2], short, passage + own[3], passage + own[0][::-1]]
    docs = documents(*texts, ids=[1, 2, 2, 2, None, None])
    kept = {(row.doc_id, row.text.strip()) for row in sentences.without_repeats(docs).collect()}
    expected = [(1, texts[0]), (2, own[1]), (2, own[2]), (2, short), (None, own[3]), (None, own[0][::-1])]
    assert kept == {(doc_id, text.strip()) for doc_id, text in expected}
    # Without the first document, one of the texts without id keeps the passage.
    spans = sentences.removed_spans(documents(*texts[4:], ids=[None, None])).collect()
    assert [(row.doc_id, row.first_id, row.removed_text) for row in spans] == [(None, None, passage)]


ITEM = "A train leaves Paris at 7 and runs 120 km to the city of Lyon in 2 hours, how fast does it run"
OTHER = "A train leaves Rome at 9 and runs 340 km to the city of Turin in 5 hours, how fast does it run"
WRONG = "A train leaves Paris at 7 and runs 120 km to the city of Lyon in 2 hours, how fast does it fly home at 7"


def test_copies_and_other_parameters_are_leaks(spark, documents):
    benchmark = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (4, "what is it"), (None, "alpha beta gamma delta epsilon")], "item_id long, text string")
    docs = documents(
        "So. " + ITEM + ". Yes.", "So " + OTHER, ITEM.upper(), "A train leaves Paris at 7 and then stops.", None, "", "what is it", "x alpha beta gamma delta epsilon y"
    )
    rows = {(row.doc_id, row.item_id): row for row in decontamination.contamination(docs, benchmark).collect()}
    assert set(rows) == {(0, 1), (1, 1), (2, 1), (6, 4), (7, None)}
    assert not rows[0, 1].reparameterised and rows[1, 1].reparameterised and rows[0, 1].share == 1
    kept = decontamination.without_leaks(docs.selectExpr("*", "1 AS id", "2 AS h"), benchmark)
    assert sorted(row.doc_id for row in kept.collect()) == [3, 4, 5]
    assert decontamination.contamination(docs, benchmark.limit(0)).count() == 0
    assert decontamination.contamination(docs.limit(0), benchmark).count() == 0


def test_a_leak_takes_no_other_text_without_id_or_with_its_id(spark, documents):
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = documents("So. " + ITEM, "clean", "So. " + ITEM, "clean too", ids=[None, None, 3, 3])
    kept = decontamination.without_leaks(docs, benchmark)
    assert kept.columns == docs.columns and sorted(row.text for row in kept.collect()) == ["clean", "clean too"]


def test_inconsistent_slots_are_no_leak(spark, documents):
    item = "if 5 apples and 5 pears and 5 plums and 5 figs and 5 nuts cost the same then why"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    same, mixed = item.replace("5", "8"), "if 1 apples and 2 pears and 3 plums and 4 figs and 6 nuts cost the same then why"
    assert [row.doc_id for row in decontamination.contamination(documents(same, mixed), benchmark).collect()] == [0]


def test_exact_copies_of_short_items_and_of_items_without_literals(spark, documents):
    items = [
        "What is the capital of France?",
        "Which animal did Mary Jones see first at the zoo?",
        "What is 12 times 7?",
        "12 + 7 - 5 * 8 =",
        "Anna Bell, Carl Dent, Emma Fox: 1 2 3 4 5 6 7 8 9 10 11 12 13 14",
        "?!",
        None,
    ]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [f"Question: {items[0]} Paris.", f"He asked Tom {items[1]}", f"so\nwhat is 12 times 7? 84", items[3], f"Then {items[4]} end"]
    texts += ["we know Paris is the capital of France.", "it is 12 + 7", "What is 12", "what is the capital of", "", "?!", None]
    found = {(row.doc_id, row.item_id): row for row in decontamination.contamination(documents(*texts), benchmark).collect()}
    assert set(found) == {(i, i) for i in range(5)}
    assert all(row.matched == row.usable >= 1 and row.share == 1 for row in found.values())
    kept = decontamination.without_leaks(documents(*texts), benchmark).collect()
    assert sorted(row.doc_id for row in kept) == list(range(5, 12))


def test_given_leaks_are_found(spark, small):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = {(row.doc_id, row.item_id) for row in decontamination.contamination(small, benchmark).collect()}
    spaced = lambda text: " " + " ".join(words(text.lower())) + " "
    items = [(row.item_id, spaced(row.text)) for row in benchmark.collect()]
    expected = {(row.doc_id, item) for row in small.collect() for item, text in items if text in spaced(row.text)}
    assert expected and found >= expected and len(found) <= len(expected) + 2


def test_items_of_one_to_three_words_as_sentences_of_their_own(spark, documents):
    items = ["Name three primes", "Why?", "Who? When?", "2 + 2 ="]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = ["name three primes", "Quiz. Name three primes! 2, 3, 5", "He could name three primes at once.", "So\nwhy\nnot", "why not", "Who? When? Where", "who when", "2 2", "2 2 2"]
    found = {(row.doc_id, row.item_id) for row in decontamination.contamination(documents(*texts), benchmark).collect()}
    assert found == {(0, 0), (1, 0), (3, 1), (5, 2), (6, 2), (7, 3)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_neighbours_and_likeness(spark, small, monkeypatch):
    monkeypatch.setattr(fingerprints, "SLICE_ROWS", 20)
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (None, "no id here"), (10**6 + 2, "é" * 9)], "doc_id long, text string")
    docs = small.select("doc_id", "text").union(extra)
    rows = docs.collect()
    order = sorted(((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in rows))
    found = {row.doc_id: row for row in fingerprints.neighbour_likeness(docs).collect()}
    assert len(found) == len(rows)
    errors = []
    for (known, doc_id, text), (_, _, following) in zip(order, order[1:] + order[:1]):
        row = found[doc_id if known else None]
        quarter = len(text) // 4
        after = text[: len(text) - quarter] + following[:quarter]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(after.encode()).hexdigest()
        errors.append(row.near_edited - jaccard(shingles(text), shingles(after)))
        errors.append(row.near_next - jaccard(shingles(text), shingles(following)))
    assert abs(np.mean(errors)) < 0.01 and np.sqrt(np.mean(np.square(errors))) < 0.05


def test_equal_texts_have_equal_fingerprints(documents):
    rows = fingerprints.neighbour_likeness(documents("a b c d e f g", "a b c d e f g", "a b c d e f g", "")).collect()
    assert len({row.fingerprint for row in rows if row.n_chars}) == 1 and {row.near_next for row in rows if row.doc_id < 2} == {1.0}
    alone = fingerprints.neighbour_likeness(documents("one two three four five six")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert fingerprints.neighbour_likeness(documents().limit(0)).count() == 0
    plain = fingerprints.fingerprint(documents("a b c d e f g", None), ["doc_id"]).collect()
    assert plain[0].fingerprint == rows[0].fingerprint and plain[1].fingerprint == ""
