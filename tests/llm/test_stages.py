"""Stages of the pipeline on rows without ids, with repeated ids, and with clashing columns."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tillroll.llm import mixing
from tillroll.llm.batches import BATCH_BYTES

CLASHING = ["_row", "_group", "_whole", "_gone", "_id", "_rows", "_predicted", "copies", "id", "h", "n"]


@pytest.mark.parametrize("name, stage_of", corpus_pipeline.STAGES)
def test_stages_keep_clashing_columns(spark, tmp_path, documents, name, stage_of):
    texts = [f"{word} plain words of a text that stands alone {word} here" for word in ("one", "two", "three")] * 2
    docs = documents(*texts, "short text with some letters", ids=[1, 2, 3, 4, 5, 6, 7])
    docs = docs.withColumns({column: F.lit(f"own {column}") for column in CLASHING})
    spark.createDataFrame([(1, "What is the capital of the country of France?")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    made = stage_of(spark, docs, str(tmp_path))
    assert made.columns == docs.columns if name != "mixing sources" else set(made.columns) == set(docs.columns)
    rows = made.collect()
    assert rows and all(row[column] == f"own {column}" for row in rows for column in CLASHING if column != "copies")
    assert stage_of(spark, docs.limit(0), str(tmp_path)).count() == 0


@pytest.mark.parametrize("ids", [[None] * 100, [7] * 100, list(range(100))])
def test_mixed_words_come_near_targets_whatever_the_ids(documents, ids):
    docs = documents(*[f"text {i % 50} " + "word " * (i % 9) for i in range(100)], ids=ids)
    docs = docs.withColumn("source", F.concat(F.lit("s"), (F.monotonically_increasing_id() % 3).cast("string")))
    asked = {row.source: row.target for row in mixing.mixture(docs).collect()}
    size = F.size(F.expr(r"regexp_extract_all(text, '[^\\s]+', 0)"))
    taken = mixing.mixed_documents(docs).groupBy("source").agg(F.sum(F.col("copies") * size).alias("taken")).collect()
    for row in taken:
        assert abs(row.taken - asked[row.source]) <= 3 * 11


@pytest.mark.parametrize("log_bits", [6, mixing.LOG_BITS])
def test_most_rows_of_the_mix_are_known_without_the_list(spark, documents, monkeypatch, log_bits):
    """Copies of a row, and rows that share bits of the small sets, meet the list; all have its copies."""
    monkeypatch.setattr(mixing, "LOG_BITS", log_bits)
    texts = [f"text {i} " + "word " * (i % 9) for i in range(90)] + ["", None, "twice is here"] + ["twice is here"] * 2
    docs = documents(*texts, ids=[*range(93), 92, 92])
    docs = docs.withColumn("source", F.concat(F.lit("s"), (F.coalesce("doc_id", F.lit(0)) % 3).cast("string")))
    asked = {row.doc_id: row.copies for row in mixing.mixture(docs).groupBy("doc_id").agg(F.sum("copies").alias("copies")).collect()}
    taken = mixing.mixed_documents(docs).collect()
    assert sorted(row.doc_id for row in taken) == sorted(i for i, copies in asked.items() if copies)
    assert all(row.copies == asked[row.doc_id] for row in taken)
    chosen = spark.createDataFrame([(i, i % 4, 1 + (i > 90)) for i in range(100)], "_row long, copies long, _rows long")
    known = chosen.select("_rows", "copies", mixing.known_copies(chosen)(F.col("_row")).alias("known")).collect()
    assert all(row.known == -1 for row in known if row._rows > 1)
    assert all(row.known in (-1, row.copies) for row in known)
    assert log_bits == 6 or all(row.known == row.copies for row in known if row._rows == 1)


def test_copies_of_a_row_are_looked_up_once_in_python(spark, documents):
    """The sure rows, and those that meet one of the two lists, wait for one worker each, not two."""
    docs = documents(*[f"text {i} " + "word " * (i % 9) for i in range(30)])
    made = mixing.mixed_documents(docs)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 3


def test_mixing_sends_texts_in_small_batches(spark, documents):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert mixing.mixture(documents("a text", "another one")).count() == 2
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(BATCH_BYTES)
