"""Operators that judge one row at a time, the mixture and the pipeline."""

import random
import re
import time
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
from llm_helpers import ascii_lower, components_of, shingles, words
from pyspark.sql import functions as F

from tillroll.llm import chat, decontamination, language, license_rules, licenses, mixing, toxicity, urls
from tillroll.llm.registry import LLM_QUERIES
from tillroll.staging import stage

MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def middle(spark):
    return spark.read.parquet(f"{MIDDLE}/documents.parquet")


def test_language_of_held_out_documents(spark, middle):
    model = language.learn_from_documents(middle)
    texts = [None, "", "12 ?! 34", "\u0301\u0301 \u0302", "Русский текст", "漢字", "the river and the house Ω", "\u0301ñ"]
    extra = spark.createDataFrame([(-i, text) for i, text in enumerate(texts, 1)], "doc_id long, text string")
    rows = middle.select("doc_id", "text").union(extra)
    found = {row.doc_id: row for row in language.predict(rows, model, ["doc_id"]).collect()}
    assert all((found[i].lang_pred, found[i].score, found[i].spans) == ("und", 0.0, []) for i in (-1, -2, -3, -4))
    # Only a text without a letter is unknown; an unknown script beside others is no evidence.
    assert all(found[i].lang_pred in model.languages and 0 < found[i].score <= 0.25 for i in (-5, -6))
    assert found[-7].lang_pred == "en" and found[-8].lang_pred in model.languages
    assert [(span.start, span.stop) for span in found[-8].spans] == [(1, 2)]
    held_out = middle.filter(language.is_held_out()).collect()
    right = [found[row.doc_id].lang_pred == row.lang for row in held_out]
    assert sum(right) / len(right) > 0.98 and all(0 <= row.score <= 1 for row in found.values())


def test_spans_of_a_mixed_text(middle):
    model = language.learn_from_documents(middle)
    parts = {lang: max((r.text for r in middle.filter(f"lang = '{lang}' AND n_chars < 1500").collect()), key=len) for lang in ("de", "en")}
    text = parts["de"] + "\n" + parts["en"]
    mixed = middle.limit(1).select("doc_id", F.lit(text).alias("text"))
    spans = language.predict(mixed, model, ["doc_id"]).first().spans
    letters = Counter()
    for span in spans:
        letters[span.lang, span.start >= len(parts["de"])] += span.stop - span.start
    assert letters["de", False] > 0.8 * len(parts["de"]) and letters["en", True] > 0.8 * len(parts["en"])


def test_nothing_to_learn_from(spark, documents):
    docs = documents("some text", None, lang=None)
    assert [row.lang_pred for row in language.identify(docs).collect()] == ["und", "und"]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {(row.score, row.predicted) for row in toxicity.toxicity(docs, labels).collect()} == {(0.0, 0)}
    assert language.identify(docs.limit(0)).count() == 0 and toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_only_texts_without_letters_leave_the_pipeline(documents):
    texts = [*["some plain english text"] * 6, "Русский текст", "12 Ω 7", "12 ?! 34", "", None]
    kept = language.keep_identified(documents(*texts))
    assert sorted(row.text for row in kept.collect()) == sorted(texts[:8])
    unlabelled = language.keep_identified(documents("some text", "1", None, lang=None))
    assert [row.text for row in unlabelled.collect()] == ["some text"]


def test_the_language_stage_writes_what_it_predicts(middle):
    wrong = middle.withColumn("lang", F.when(language.fold() == language.HELD_OUT, "xx").otherwise(F.col("lang")))
    kept = language.keep_identified(wrong.withColumn("_other", F.lit(1)))
    assert kept.columns == [*middle.columns, "_other"]
    truth = {row.doc_id: row.lang for row in middle.select("doc_id", "lang").collect()}
    found = [row.lang == truth[row.doc_id] for row in kept.filter(language.is_held_out()).collect()]
    assert sum(found) / len(found) > 0.98
    predicted = {row.doc_id: row.lang_pred for row in language.identify(wrong).collect()}
    assert {row.doc_id: row.lang for row in kept.collect()} == {i: lang for i, lang in predicted.items() if lang != "und"}


def test_toxicity_of_held_out_documents_and_of_hidden_insults(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.learn_from_labels(docs, labels)
    plain = "the heonand of thing is an one there. "
    texts = [plain, plain + "you idiot", plain + "YOU I D I O T!", plain + "an i-d-i-o-t", plain + "an idiiot", "", None]
    made = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "doc_id long, text string")
    found = [row.predicted for row in toxicity.score(made, model, ["doc_id"]).orderBy("doc_id").collect()]
    assert found == [0, 1, 1, 1, 1, 0, 0]
    held_out = labels.filter(toxicity.is_held_out()).join(toxicity.score(docs, model, ["doc_id"]), "doc_id").collect()
    caught = [row.predicted for row in held_out if row.toxic == 1]
    alarms = [row.predicted for row in held_out if row.toxic == 0]
    assert sum(caught) > 0.85 * len(caught) and sum(alarms) < 0.08 * len(alarms)


def test_a_phrase_of_ordinary_words_is_toxic(spark):
    draw = random.Random(3)
    plain = ["river", "house", "green", "seven", "under", "light", "paper", "stone", "water", "garden"]
    rows = []
    for i in range(1200):
        own = draw.choices(plain, k=30)
        for word in ["drop dead now"] if i % 3 == 0 else ["drop", "dead", "now"]:
            own.insert(draw.randrange(len(own)), word)
        text = " ".join(own)
        rows.append((i, text.replace("drop dead now", "drop dead, now") if i % 3 else text, int(i % 3 == 0)))
    rows = [row for row in rows if row[2] or "drop dead" not in row[1]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.toxicity(docs, docs).join(docs.select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    caught = [row.predicted for row in found if row.toxic]
    alarms = [row.predicted for row in found if not row.toxic]
    assert len(caught) > 50 and sum(caught) >= 0.9 * len(caught) and sum(alarms) <= 0.05 * len(alarms)


def subsequence_weights(span):
    """Weight of every gapped subsequence, position by position."""
    weights = Counter()
    for at in combinations(range(len(span)), toxicity.LETTERS):
        if at[-1] - at[0] < toxicity.SPAN:
            weights[tuple(span[i] for i in at)] += toxicity.DECAY ** (at[-1] - at[0] - toxicity.LETTERS + 1)
    return weights


def test_linear_form_equals_brute_force_kernel(middle):
    texts = [row.text for row in middle.filter("n_chars < 400").orderBy("doc_id").limit(50).collect()]
    texts += ["", "a", "i d i o t! Yes", "one. two\nthree"]
    groups = toxicity.letter_groups([text.lower() for text in texts])
    every = toxicity.spans(groups)
    # Spans never leave a sentence.
    alone = [toxicity.spans(toxicity.letter_groups([part])) for part in ("i d i o t!", "yes", "one.", "two", "three")]
    last = [every.word(i) for i in np.flatnonzero(every.text >= len(texts) - 2)]
    assert last == [each.word(i) for each in alone for i in range(len(each.start))]
    words = sorted({every.word(i) for i in range(len(every.start))})
    model = toxicity.ToxicityModel(None, 0.0, 1.0, 0.0, 0.0)
    model.weights, model.bias = toxicity.fit_machine([(word, 1.0) for word in words[:40]], [(word, 2.0) for word in words[40:90]])
    found = toxicity.decisions(model, every)
    for i in range(0, len(found), 7):
        own = subsequence_weights(every.word(i))
        feature = lambda letters: int(sum(letter << 5 * k for k, letter in enumerate(reversed(letters))))
        expected = sum(weight * float(model.weights[feature(letters)]) for letters, weight in own.items())
        size = np.array([len(every.word(i))])
        assert found[i] == pytest.approx(expected / toxicity.norms(size)[0] + model.bias, abs=1e-4)
    # The kernel of two spans is the product of their subsequence weights.
    columns = np.arange(toxicity.FEATURES)
    vectors = toxicity.vectors(words[:6], columns, toxicity.FEATURES)
    for a in range(6):
        for b in range(6):
            first, second = subsequence_weights(words[a]), subsequence_weights(words[b])
            sizes = toxicity.norms(np.array([len(words[a]), len(words[b])]))
            product = sum(weight * second[letters] for letters, weight in first.items())
            assert float(vectors[a] @ vectors[b]) == pytest.approx(product / sizes.prod(), abs=1e-5)


def phrases_in(text):
    own = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text or ""))
    at = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(own)) if own[i : i + len(phrase.split())] == phrase.split()]
    return len(own), sorted(i for i, _ in at), sorted({label for _, label in at})


def test_license_phrases_equal_brute_force(spark, middle):
    made = [None, "", " !", "Under the MIT-License", "cc by nc cc by nc", "CC BY-NC 4.0; Apache License\nVersion 2", "Åunder the mit license", "under the mit licenseé", "Kcc by nc"]
    rows = spark.createDataFrame([(-i - 1, text) for i, text in enumerate(made)], "doc_id long, text string").union(middle.select("doc_id", "text"))
    texts = {row.doc_id: row.text for row in rows.collect()}
    for row in licenses.scan(rows, ["doc_id"]).collect():
        n, places, labels = phrases_in(texts[row.doc_id])
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (n, len(places), min(places, default=None), max(places, default=None))
        assert row.base_labels == ",".join(labels) and set(labels) <= set(row.labels.split(",")) | {""} and 0 <= row.score <= 1


def test_many_license_matches_in_one_text(spark):
    times = 16000
    texts = ["mit license " * times, "x under the mit license cc by nc " * 300, "cc by nc"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    start = time.perf_counter()
    many, mixed, one = licenses.scan(docs, ["doc_id"]).orderBy("doc_id").collect()
    assert time.perf_counter() - start < 30
    assert (many.n_words, many.n_base, many.labels) == (2 * times, 0, "mit") and one.labels == "cc-by-nc"
    assert (mixed.n_base, mixed.first_word, mixed.last_word) == (600, 1, 299 * 8 + 5)


def test_license_intervals_have_their_places(spark):
    text = " a b cc d b cc b" * 100 + " "
    rule = F.struct(F.lit(1).alias("priority"), F.lit("l").alias("label"), F.lit(0.5).alias("confidence"), F.lit(" b(?= )").alias("expression"))
    row = spark.range(1).select(licenses.intervals_of(F.lit(text), rule).alias("all"), licenses.intervals_of(F.lit(" x "), rule).alias("none")).first()
    places = [i for i, word in enumerate(text.split()) if word == "b"]
    assert [(each.start, -each.left) for each in row["all"]] == [(i, i + 1) for i in places] and row["none"] == []


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the GNU General Public License, version 3.", "gpl-3"),
        ("Released under the GNU General Public License.", "gpl"),
        ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3"),
        ("under the MIT License and the Mozilla Public License 2.0", "mit,mpl-2"),
        ("Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
        ("It is licensed, but nobody says how.", ""),
    ],
)
def test_license_rules(documents, text, labels):
    row = licenses.scan(documents(text), ["doc_id"]).first()
    assert row.labels == labels and (row.score > 0) == bool(labels)


def alternatives(expression):
    """All texts that an expression of optional parts, branches and classes matches."""
    joined_to = lambda heads, tails: [head + tail for head in heads for tail in tails]

    def texts(parsed):
        found = [""]
        for kind, value in parsed:
            kind = str(kind)
            if kind == "LITERAL":
                own = [chr(value)]
            elif kind == "IN":
                own = [chr(low) for _, item in value for low in ([item] if isinstance(item, int) else range(item[0], item[1] + 1))]
            elif kind == "BRANCH":
                own = [text for branch in value[1] for text in texts(branch)]
            elif kind == "SUBPATTERN":
                own = texts(value[3])
            else:
                assert kind == "MAX_REPEAT" and value[:2] == (0, 1)
                own = [*texts(value[2]), ""]
            found = joined_to(found, own)
        return found

    return texts(re._parser.parse(expression))


def test_every_alternative_of_every_license_rule_is_found(spark):
    """In texts with line feeds and hyphens between the words."""
    asked = set()
    for label, _, names, identifier in license_rules.FAMILIES:
        # A name that ends in a blank has none after it in a normalised text.
        asked |= {(label, f"licensed under {name}") for name in alternatives(names) if not name.endswith(" ")}
        asked |= {(label, f"spdx license identifier {name}") for name in alternatives(identifier) if name}
    for label, _, _, _, expression in license_rules.TEXTS:
        asked |= {(label, text.strip()) for text in alternatives(expression)}
    asked = sorted(asked)
    texts = [text.upper().replace(" ", "\n" if i % 2 else "-") for i, (_, text) in enumerate(asked)]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {row.doc_id: row.labels.split(",") for row in licenses.scan(made, ["doc_id"]).collect()}
    missed = [(pair, found[i]) for i, pair in enumerate(asked) if pair[0] not in found[i]]
    assert not missed


def test_urls(spark):
    rows = [
        ("https://WWW.a.net/x?y#z", "www.a.net", "/x", "net/", "block"),
        ("http://b.example.net/en/1", "b.example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("http://x.org/fr/a", "x.org", "/fr/a", "org/fr/", "allow"),
        ("http://x.org/french", "x.org", "/french", None, "allow"),
        ("http://q.net", "q.net", "", None, "allow"),
        ("http://r.net?u=://b.org/fr", "r.net", "", None, "allow"),
        ("http://notnet/x", "notnet", "/x", None, "allow"),
        ("no scheme/x", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("", "", "", None, "allow"),
    ]
    pages = spark.createDataFrame([(i, row[0]) for i, row in enumerate(rows)], "page_id long, url string")
    found = urls.judge_urls(pages, ["page_id"]).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == [row[1:] for row in rows]
    assert urls.judge_urls(pages.limit(0), ["page_id"]).count() == 0


def test_mined_rules_reach_other_hosts(spark):
    bad = [(f"http://pills{i % 3}.bad-shop.net/p/{i}",) for i in range(40)]
    good = [(f"http://news.example.net/en/{i}",) for i in range(40)]
    asked = [("http://other.bad-shop.com/p/1",), ("http://news.example.com/x",)]
    pages = spark.createDataFrame([*bad, *good, *asked], "url string")
    found = {row.url: row.verdict for row in urls.judge_urls(pages, ["url"]).collect()}
    assert [found[url] for url, in asked] == ["block", "allow"]


def test_targets_and_words_of_the_mix(spark, middle):
    extra = spark.createDataFrame([(-1, None, None), (-2, "", "t"), (-3, "a b", None), (-4, "z " * 9, "src19")], "doc_id long, text string, source string")
    docs = middle.select("doc_id", "text", "source").union(extra)
    rows = mixing.mixture(docs).collect()
    texts = {row.doc_id: row for row in docs.collect()}
    size = {i: len(words(row.text)) for i, row in texts.items()}
    whole = defaultdict(int)
    for i, row in texts.items():
        whole[row.source] += size[i]
    order = sorted(whole, key=lambda source: (source is None, source))
    weight = {source: i % 3 + 1 for i, source in enumerate(order)}
    goal, free, left = {}, set(order), sum(size.values())
    while True:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if 3 * whole[s] < weight[s] * level}
        goal |= {s: 3 * whole[s] for s in full}
        left -= sum(3 * whole[s] for s in full)
        free -= full
        if not full:
            break
    goal |= {s: weight[s] * level for s in free}
    taken = Counter()
    for row in rows:
        assert row.size == size[row.doc_id] and row.source_size == whole[row.source] and row.target == pytest.approx(goal[row.source])
        assert row.taken % max(row.size, 1) == 0 and row.taken <= 3 * row.size
        taken[row.source] += row.taken
    assert len(rows) == len(texts)
    for source in order:
        assert abs(taken[source] - goal[source]) <= max(10, 0.01 * goal[source])
    assert mixing.mixture(docs.limit(0)).count() == 0


def test_many_blocks_balance_and_agree(spark, middle, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 10)
    units = middle.selectExpr("source", "doc_id", "n_chars AS size", "50L AS documents", "0.3D AS p")
    first, second = (sorted(map(tuple, mixing.balanced_sample(units, 10).collect())) for _ in range(2))
    assert first == second and len(first) == 1000 and {row[4] for row in first} == {0.0, 1.0}
    for source in {row[0] for row in first}:
        own = [row for row in first if row[0] == source]
        assert abs(sum(r[2] * r[4] for r in own) - 0.3 * sum(r[2] for r in own)) < 0.05 * sum(r[2] for r in own)


def test_chat_roles_and_rendering(spark, monkeypatch):
    taught = stage(spark.read.parquet(f"{MIDDLE}/conversations.parquet"))
    found = chat.format_chats(taught).withColumnRenamed("role", "found").join(taught, ["conv_id", "turn"])
    right = found.filter("found = role").count() / found.count()
    assert right > 0.95
    model = chat.model_of(__import__("numpy").zeros(chat.STATES + chat.STATES**2 + chat.STATES * chat.SYMBOLS))
    rows = [(1, 0, "User: Hi\nAssistant: Hello.\nHow are you?\n### Human: fine"), (1, 1, "AI: good"), (2, 0, None), (None, 5, "system: x"), (2, None, "Q: why")]
    made = spark.createDataFrame([(c, t, None, text) for c, t, text in rows], "conv_id long, turn long, role string, text string")
    out = {(row.conv_id, row.turn): row for row in chat.format_chats(made, model).collect()}
    assert out[1, 0].rendered == "<|user|>\nHi\n<|end|>\n<|assistant|>\nHello.\nHow are you?\n<|end|>\n<|user|>\nfine"
    assert out[1, 1].rendered == "<|end|>\n<|assistant|>\ngood" and out[None, 5].role == "system" and out[2, None].role == "user"
    assert len(out) == 5 and chat.format_chats(made.limit(0), model).count() == 0


def test_long_conversations_are_decoded_in_blocks(spark, monkeypatch):
    rows = spark.range(300).selectExpr("id % 2 AS conv_id", "id AS turn", "CAST(NULL AS STRING) AS role", "if(id % 4 < 2, 'User: a', concat('x', id)) AS text")
    model = chat.model_of(__import__("numpy").zeros(chat.STATES + chat.STATES**2 + chat.STATES * chat.SYMBOLS))
    whole = sorted(map(tuple, chat.format_chats(rows, model).collect()))
    monkeypatch.setattr(chat, "BLOCK", 7)
    assert sorted(map(tuple, chat.format_chats(rows, model).collect())) == whole


def test_pipeline_equals_its_steps_by_brute_force(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    benchmark = spark.read.parquet(f"{small}/benchmark.parquet")
    steps, kept = [docs], docs
    for _, function in corpus_pipeline.STAGES:
        kept = stage(function(spark, kept, small))
        steps.append(kept)
    ids = [{row.doc_id for row in step.collect()} for step in steps]
    assert ids[1] == {row.doc_id for row in docs.collect() if re.search(r"[^\W\d_]", row.text or "")}
    links = components_of({row.doc_id: shingles(row.text) for row in steps[1].collect()})
    assert ids[2] == {i for i, component in links.items() if i == component}
    assert ids[3] <= ids[2] and ids[4] == ids[3] - {r.doc_id for r in decontamination.contamination(steps[3], benchmark).collect()}
    copies = {r.doc_id: r.copies for r in mixing.mixture(steps[4]).collect()}
    assert {r.doc_id: r.copies for r in steps[5].collect()} == {i: n for i, n in copies.items() if n}
    assert all(step.columns == docs.columns for step in steps[:5])
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == sorted(map(tuple, steps[5].collect()))


def test_every_operator_has_its_query():
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in LLM_QUERIES] == list(range(1, 14))
