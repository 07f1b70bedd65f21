import numpy as np
import pandas as pd
import pytest
from frames import counted, line
from pyspark.sql import functions as F

from tillroll.operators import distributions, profiling, sampling


@pytest.fixture
def dirty(raw_frame):
    return raw_frame(
        line(),
        line(),
        line(),
        line(description=None, customer_id=None, quantity=-3),
        line(description="a?b", price="0.00", quantity=0),
        line(description="abc", price="-2.00", stock_code=None),
    )


def test_nulls_and_patterns(dirty):
    nulls = {row.column: (row.nulls, row.null_ratio) for row in profiling.null_profile(dirty).collect()}
    assert nulls["description"] == (1, 1 / 6) and nulls["customer_id"] == (1, 1 / 6) and nulls["invoice"] == (0, 0)
    patterns = {
        (row.description, row.stock_code, row.customer_id): row.rows
        for row in profiling.null_patterns(dirty).collect()
    }
    assert patterns == {(0, 0, 0): 4, (1, 0, 1): 1, (0, 1, 0): 1}


def test_null_profile_of_no_rows(dirty):
    empty = profiling.null_profile(dirty.limit(0)).collect()
    assert [(row.nulls, row.null_ratio) for row in empty] == [(0, None)] * 8


def test_sign_audit(dirty):
    assert tuple(profiling.sign_audit(dirty).first()) == (1, 1, 1, 1)


def test_overview(dirty):
    rows = profiling.dataset_overview(dirty).collect()
    assert [row.column for row in rows] == dirty.columns
    assert {(row.rows, row.columns, row.duplicate_rows) for row in rows} == {(6, 8, 2)}
    assert {row.column: row.non_null for row in rows}["stock_code"] == 5
    assert rows[5].type == "decimal(10,2)"


def test_top_values_leave_nulls_out(dirty):
    rows = profiling.top_values(dirty, ["description"], k=2).orderBy("position").collect()
    assert [(r.distinct_values, r.position, r.value, r.share) for r in rows] == [
        (3, 1, "white heart", 0.6),
        (3, 2, "a?b", 0.2),
    ]


@pytest.mark.parametrize("mode", ["one slice", "sliced"])
def test_summary_equals_pandas(spark, request, mode):
    if mode == "sliced":
        request.getfixturevalue("sliced")
    df = spark.range(2003).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.hash("id"), F.lit(900))).cast("int").alias("x"),
        (F.pmod(F.hash("id"), F.lit(100_000)) / 100).cast("decimal(10,2)").alias("y"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("z"),
        F.lit("text").alias("t"),
    )
    expected = df.select("x", F.col("y").cast("double"), "z").toPandas().describe()
    found = {row.column: row for row in profiling.numeric_summary(df).collect()}
    assert set(found) == {"x", "y", "z"}
    for name, row in found.items():
        ours = [row["count"], row.mean, row.std, row.min, row.q25, row.q50, row.q75, row.max]
        np.testing.assert_allclose(ours, expected[name].tolist(), rtol=1e-12)


@pytest.mark.parametrize("values", [[1, 2, 3, 4], [5], [1, 9], [2, 2, 2, 7, 8]])
def test_quartiles_are_linear(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    row = profiling.numeric_summary(df).first()
    expected = pd.Series(values).describe()
    assert [row.q25, row.q50, row.q75] == expected[["25%", "50%", "75%"]].tolist()
    assert row.std == (None if len(values) == 1 else pytest.approx(expected["std"]))


def test_date_summary(raw_frame):
    stamps = ["2010-12-01 08:00:00", "2010-12-02 09:30:00", "2010-12-05 00:00:01", "2011-03-27 02:30:00"]
    row = profiling.date_summary(raw_frame(*[line(when=s) for s in stamps])).first()
    expected = pd.Series(pd.to_datetime(stamps)).describe()
    assert row["count"] == 4
    for ours, theirs in [("mean", "mean"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
        assert abs(pd.Timestamp(row[ours]) - expected[theirs]) < pd.Timedelta(microseconds=2)


def test_columns_without_a_value_and_dates_of_any_kind(spark):
    df = spark.createDataFrame(
        [(1, None, None, "2010-12-01 08:00:00"), (3, None, None, None)], "x int, y double, t string, s string"
    ).selectExpr("*", "CAST(s AS timestamp) AS moment", "CAST(s AS date) AS day", "CAST(NULL AS date) AS never")
    numbers = {row.column: row for row in profiling.numeric_summary(df).collect()}
    assert (numbers["x"]["count"], numbers["y"]["count"], numbers["y"].mean, numbers["y"].q50) == (2, 0, None, None)
    dates = {row.column: row for row in profiling.date_summary(df).collect()}
    assert str(dates["moment"].max) == "2010-12-01 08:00:00" and str(dates["day"].q50) == "2010-12-01 00:00:00"
    assert (dates["never"]["count"], dates["never"].min) == (0, None)
    texts = {row.column: row for row in profiling.top_values(df).collect()}
    assert (texts["t"].distinct_values, texts["t"].position, texts["t"].share) == (0, None, None)
    assert (texts["s"].distinct_values, texts["s"].value, texts["s"].share) == (1, "2010-12-01 08:00:00", 1.0)
    nothing = df.limit(0)
    assert [row["count"] for row in profiling.numeric_summary(nothing).collect()] == [0, 0]
    assert profiling.top_values(nothing).count() == 2


def test_columns_by_type(dirty):
    assert profiling.numeric_columns(dirty) == ["quantity", "price", "customer_id"]
    assert profiling.text_columns(dirty) == ["invoice", "stock_code", "description", "country"]
    assert profiling.timestamp_columns(dirty) == ["invoice_date"]


def test_text_listings(dirty):
    assert [tuple(r) for r in profiling.short_descriptions(dirty).collect()] == [("a?b", 1), ("abc", 1)]
    assert [tuple(r) for r in profiling.question_descriptions(dirty).collect()] == [("a?b", 1)]
    assert profiling.frequent_texts(dirty, F.lit(True), 1).first().n == 3


def test_head_and_tail(raw_frame):
    df = raw_frame(*[line(quantity=q, stock_code=str(q)) for q in (5, 3, 3, 9)], line(quantity=None, stock_code="n"))
    rows = profiling.extreme_quantities(df, 2).collect()
    assert [(r.part, r.position, r.quantity) for r in rows] == [
        ("head", 1, 9),
        ("head", 2, 5),
        ("tail", 1, None),
        ("tail", 2, 3),
    ]


def test_priciest_products_in_order_of_first_sight(raw_frame):
    df = raw_frame(
        line(stock_code="b", description="x", price="9.00"),
        line(stock_code="a", description="x", price="8.00"),
        line(stock_code="b", description=None, price="7.00"),
        line(stock_code="z", description="late", price="1.00"),
    )
    found = {(r.kind, r.value): r.first_position for r in profiling.priciest_products(df, 3).collect()}
    assert found == {("description", "x"): 1, ("description", None): 3, ("stock_code", "b"): 1, ("stock_code", "a"): 2}


def test_sample_has_exact_size_and_ignores_layout(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("k"), F.lit(None).cast("string").alias("t"))
    sample = sorted(sampling.sample_rows(df, 700, seed=1).collect())
    assert len(sample) == len({row.id for row in sample}) == 700
    assert sample == sorted(sampling.sample_rows(df.repartition(13, "k"), 700, seed=1).collect())
    assert sample != sorted(sampling.sample_rows(df, 700, seed=2).collect())
    assert sampling.sample_rows(df, 9999).count() == 5000
    shares = pd.Series([row.k for row in sample]).value_counts(normalize=True)
    assert shares.min() > 0.25


def test_sample_of_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BLOCK", 8)
    df = spark.createDataFrame([(i % 100, None if i % 2 else "") for i in range(400)], "x int, t string")
    for n in (150, 300):
        taken = pd.Series([tuple(row) for row in sampling.sample_rows(df, n).collect()]).value_counts()
        assert taken.sum() == n and taken.max() <= 4
        # Copies are drawn for one by one, not as a group.
        assert set(taken) - {4} and len(taken) > n // 4
    hot = spark.createDataFrame([(1,)] * 900 + [(2,)] * 100, "x int")
    taken = pd.Series([row.x for row in sampling.sample_rows(hot, 500).collect()]).value_counts()
    assert taken.sum() == 500 and 20 < taken[2] < 80
    assert sampling.sample_rows(hot, 0).count() == 0 and sampling.sample_rows(hot.limit(0), 5).count() == 0


def test_sample_ends_inside_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(sampling, "LEVEL", 1)
    df = spark.range(3000).withColumn("text", F.lit("a|b"))
    samples = [{row.id for row in sampling.sample_rows(df, n).collect()} for n in (1, 10, 999, 1000, 2999)]
    assert [len(ids) for ids in samples] == [1, 10, 999, 1000, 2999]
    assert all(small < large for small, large in zip(samples, samples[1:]))


def test_a_sampled_frame_is_computed_once(spark):
    df, seen = counted(spark.range(300).selectExpr("id", "id % 7 AS x"))
    assert sampling.sample_rows(df, 50).count() == 50 and seen.value == 300


def test_both_ends_read_rows_computed_once(spark):
    df, seen = counted(spark.range(300).selectExpr("id", "id % 7 AS x"))
    ends = profiling.head_and_tail(df, "id", ["x", "id"], 2)
    assert sorted(tuple(row) for row in ends.collect()) == [
        ("head", 1, 5, 299), ("head", 2, 4, 298), ("tail", 1, 0, 0), ("tail", 2, 1, 1),
    ]
    assert seen.value == 300


def test_density_computes_its_frame_once(spark):
    df, seen = counted(spark.range(300).selectExpr("id", "id % 7 AS x"))
    assert distributions.density(df, ["x"], n=50, points=5).count() == 5 and seen.value == 300


def test_a_sample_of_some_columns_stages_these_and_a_digest(spark, monkeypatch):
    df = spark.range(300).selectExpr("id", "id % 7 AS x", "repeat('text', 9) AS `a.b`").unionByName(spark.sql("SELECT 5L AS id, 5L AS x, 'y' AS `a.b`"))
    whole = sampling.sample_rows(df, 50).select("x", "`a.b`")
    staged, stage = {}, sampling.stage
    monkeypatch.setattr(sampling, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    some = sampling.sample_rows(df, 50, columns=["x", "a.b"])
    assert some.columns == ["x", "a.b"] and sorted(some.collect()) == sorted(whole.collect())
    staged.clear()
    distributions.density(df, ["x"], n=50, points=5)
    assert staged["sampled"].columns == ["x", "_row"]
