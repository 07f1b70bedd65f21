import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillroll.operators import distributions
from tillroll.staging import stage


@pytest.fixture(scope="module")
def sales(spark):
    hot = F.when(F.col("id") % 3 == 0, 12).otherwise(F.pmod(F.hash("id"), F.lit(300)) - 40)
    df = spark.range(3001).select(
        hot.cast("int").alias("quantity"),
        (F.pmod(F.hash("id"), F.lit(9973)) / 100 + 0.01).cast("decimal(10,2)").alias("price"),
        (2009 + F.col("id") % 3).cast("int").alias("year"),
    )
    return stage(df.withColumn("revenue", F.col("quantity") * F.col("price")))


@pytest.fixture(scope="module")
def frame(sales):
    return sales.select("quantity", "year", *[F.col(c).cast("double").alias(c) for c in ("price", "revenue")]).toPandas()


@pytest.mark.parametrize("mode", ["one slice", "sliced"])
def test_spearman_equals_pandas(request, sales, frame, mode):
    if mode == "sliced":
        request.getfixturevalue("sliced")
    columns = ["quantity", "price", "revenue", "year"]
    matrix = distributions.spearman(sales, columns).toPandas().set_index("column")
    expected = frame[columns].corr(method="spearman")
    np.testing.assert_allclose(matrix.loc[columns, columns].to_numpy(), expected.to_numpy(), atol=1e-12)


def test_spearman_without_broadcast(spark, sales, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        matrix = distributions.spearman(sales, ["quantity", "price"]).toPandas().set_index("column")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    expected = frame[["quantity", "price"]].corr(method="spearman")
    assert matrix.loc["quantity", "price"] == pytest.approx(expected.loc["quantity", "price"])


def test_spearman_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5)], "a int, b int")
    rows = {row.column: row for row in distributions.spearman(df, ["a", "b"]).collect()}
    assert rows["a"].a == 1.0 and rows["a"].b is None


@pytest.mark.parametrize("mode", ["one slice", "sliced"])
def test_box_stats(request, sales, frame, mode):
    if mode == "sliced":
        request.getfixturevalue("sliced")
    found = {(row.column, row.year): row for row in distributions.box_stats(sales).collect()}
    assert len(found) == 6
    for (column, year), row in found.items():
        values = frame.loc[frame.year == year, column]
        q1, q2, q3 = values.quantile([0.25, 0.5, 0.75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = values[values.between(low, high)]
        ours = [row["count"], row.q25, row.q50, row.q75, row.whisker_low, row.whisker_high, row.outliers]
        theirs = [len(values), q1, q2, q3, inside.min(), inside.max(), len(values) - len(inside)]
        np.testing.assert_allclose(ours, theirs, rtol=1e-12)


def test_signed_log_histogram(sales, frame):
    rows = distributions.signed_log_histogram(sales, bins=20).orderBy("column", "bin").toPandas()
    for column in ("price", "quantity", "revenue"):
        values = np.sign(frame[column]) * np.log1p(frame[column].abs())
        counts, edges = np.histogram(values, bins=20)
        ours = rows[rows.column == column]
        assert ours.n.tolist() == counts.tolist()
        np.testing.assert_allclose(ours.left_edge, edges[:-1], atol=1e-9)
        np.testing.assert_allclose(ours.right_edge, edges[1:], atol=1e-9)


def test_length_histogram(spark):
    texts = ["a", "bb", "bb", None, "é" * 9, "x" * 11]
    df = spark.createDataFrame([(t,) for t in texts], "description string")
    rows = distributions.length_histogram(df, bins=5).orderBy("bin").toPandas()
    counts, _ = np.histogram([1, 2, 2, 9, 11], bins=5)
    assert rows.n.tolist() == counts.tolist()


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([("abc",), ("xyz",)], "description string")
    rows = distributions.length_histogram(df, bins=4).orderBy("bin").toPandas()
    counts, edges = np.histogram([3, 3], bins=4)
    assert rows.n.tolist() == counts.tolist() and rows.left_edge.tolist() == edges[:-1].tolist()


def test_density(sales, frame):
    rows = distributions.density(sales, ["price"], points=21).orderBy("point").toPandas()
    x = np.log1p(frame.price.to_numpy())
    width = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 21)
    expected = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / width) ** 2).mean(axis=1) / (width * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(rows.x, grid, rtol=1e-9)
    np.testing.assert_allclose(rows.density, expected, rtol=1e-9)


def test_density_uses_the_sample_size(sales):
    few = distributions.density(sales, ["price"], n=50, points=5).toPandas()
    assert len(few) == 5 and isinstance(few, pd.DataFrame)


def test_correlation_of_pairs_with_nulls_is_that_of_pandas(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame({name: rng.integers(0, 30, 400).astype(float) for name in "abcd"})
    frame["b"] += frame["a"]
    for name, share in (("a", 0.3), ("b", 0.5), ("d", 0.1)):
        frame.loc[rng.random(400) < share, name] = np.nan
    frame["none"] = np.nan
    frame["only"] = np.where(frame["a"].isna(), 1.0, np.nan)
    rows = [tuple(None if np.isnan(x) else float(x) for x in row) for row in frame.to_numpy()]
    df = spark.createDataFrame(rows, ", ".join(f"`{name}` double" for name in frame))
    found = distributions.spearman(df).toPandas().set_index("column").loc[list(frame), list(frame)]
    expected = frame.corr("spearman")
    np.testing.assert_allclose(found.to_numpy(float), expected.to_numpy(), atol=1e-9)
    assert distributions.spearman(df.limit(0)).toPandas().drop(columns="column").isna().all(axis=None)
