import time
from collections import defaultdict

import pandas as pd
import pytest
from frames import counted
from pyspark.sql import functions as F

from tillroll.operators import reconcile as comparison
from tillroll.operators.clustering import (
    assign_clusters,
    check_fixed_point,
    fit_clusters,
    load_model,
    save_model,
    silhouette,
)
from tillroll.operators.reconcile import reconcile
from tillroll.registry.queries import reconcile_cleaning
from tillroll.staging import stage

SCHEMA = "customer_id int, score int, ratio double, segment string"


def compare(spark, left, right):
    found = reconcile(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), "customer_id")
    return {row.column: row for row in found.collect()}


def test_mismatches_and_one_sided_rows(spark):
    found = compare(
        spark,
        [(1, 5, 1.0, "a"), (2, 5, None, None), (3, 4, 0.0, "b"), (9, 1, 1.0, "x")],
        [(1, 4, 1.000001, "a"), (2, 5, None, "z"), (3, 4, 1.0, None), (8, 1, 1.0, "x")],
    )
    assert {name: row.mismatched for name, row in found.items()} == {"score": 1, "ratio": 1, "segment": 2}
    assert all((row.compared, row.left_only, row.right_only) == (3, 1, 1) for row in found.values())
    assert found["segment"].mismatch_percent == pytest.approx(200 / 3)


def test_repeated_and_missing_keys(spark):
    row = (1, 5, 1.0, "a")
    found = compare(
        spark,
        [row, row, (1, 6, 1.0, "a"), (None, 1, None, None), (None, 2, 2.0, "b"), (4, 1, 1.0, "c")],
        [row, (1, 6, 1.0, "b"), (None, 1, None, "x"), (5, 1, 1.0, "c"), (5, 1, 1.0, "c")],
    )
    # Key 1 meets as (5, 5) and (5, 6), the missing key as (1, 1).
    assert {name: row.mismatched for name, row in found.items()} == {"score": 1, "ratio": 0, "segment": 2}
    assert {tuple(row)[5:] for row in found.values()} == {(3, 2, 3, 2)}
    assert all(row.compared == 3 for row in found.values())


def test_hot_key_and_one_sided_columns(spark, sliced):
    left = spark.range(3000).selectExpr("if(id < 1500, 7, id) AS k", "id % 40 AS v", "id AS only_left")
    right = spark.range(3000).selectExpr("if(id < 1400, 7, id) AS k", "id % 40 AS v", "1 AS only_right", "2 AS also_right")
    rows = {row.column: row for row in reconcile(left, right, "k").collect()}
    assert (rows["v"].compared, rows["v"].left_only, rows["v"].right_only) == (2900, 100, 100)
    assert (rows["v"].left_repeated, rows["v"].right_repeated) == (1499, 1399)
    places = [sorted(i % 40 for i in range(n)) for n in (1500, 1400)]
    assert rows["v"].mismatched == sum(a != b for a, b in zip(*places))
    sides = {name: (row.side, row.compared, row.mismatched) for name, row in rows.items() if name != "v"}
    assert sides == {"only_left": ("left", 0, None), "only_right": ("right", 0, None), "also_right": ("right", 0, None)}


def by_hand(left, right):
    """What ``reconcile`` has to find in rows of (k, a, b), in plain Python."""
    sides = [defaultdict(list), defaultdict(list)]
    for side, rows in zip(sides, (left, right)):
        for key, *values in rows:
            side[key].append([(value is not None, value) for value in values])
    pairs = [pair for key in {*sides[0], *sides[1]} for pair in zip(sorted(sides[0][key]), sorted(sides[1][key]))]
    more = [sum(len(rows) - 1 for rows in side.values() if rows) for side in sides]
    alone = [len(rows) - len(pairs) for rows in (left, right)]
    return {name: (len(pairs), sum(x[at] != y[at] for x, y in pairs), *alone, *more) for at, name in enumerate("ab")}


@pytest.mark.parametrize("hot_rows, pass_rows", [(10**9, 10**9), (50, 10**9), (10**9, 500), (50, 500)])
def test_hot_keys_and_passes_find_the_same(spark, sliced, monkeypatch, hot_rows, pass_rows):
    monkeypatch.setattr(comparison, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(comparison, "HOT_SHARE", 20)
    monkeypatch.setattr(comparison, "PASS_ROWS", pass_rows)
    key = lambda i, n: None if i % 4 == 0 else 7 if i % 4 == 1 else i % n
    left = [(key(i, 90), i % 6 or None, f"t{i * i % 11}" if i % 5 else None) for i in range(900)]
    right = [(key(i, 97), i % 7 or None, f"t{i * i % 13}" if i % 5 else None) for i in range(800)]
    frames = [spark.createDataFrame(rows, "k int, a int, b string").repartition(3) for rows in (left, right)]
    found = {row.column: tuple(row)[2:4] + tuple(row)[5:] for row in comparison.reconcile(*frames, "k").collect()}
    assert found == by_hand(left, right)


def test_sides_are_read_for_the_keys_and_for_the_rows(spark):
    sides, seen = zip(*(counted(spark.range(400).selectExpr("id % 90 AS k", f"id % {n} AS v")) for n in (6, 7)))
    assert comparison.reconcile(*sides, "k").collect()[0].compared == 400
    assert [count.value for count in seen] == [800, 800]


def shuffle_mb(spark):
    """Size of the shuffle files that lie on disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [files.apply(i) for i in range(files.size())]
    return sum(file.length() for file in files if file.getName().startswith("shuffle_")) / 1e6


def test_reconciled_lines_leave_no_shuffle_files(spark):
    lines = spark.range(60_000).selectExpr(
        "string(id % 20000) AS invoice", "string(id % 997) AS stock_code", "concat('jug ', id * 31 % 60000) AS description",
        "int(id % 9) AS quantity", "timestamp_ntz'2011-01-01' AS invoice_date", "decimal(id % 50) AS price",
        "int(id % 3000) AS customer_id", "'France' AS country",
    )
    before = shuffle_mb(spark)
    row = reconcile_cleaning(lines).collect()[0]
    # Lines without a quantity stay, those without a price go.
    assert (row.compared, row.left_only, row.right_only) == (58_800, 1_200, 0)
    # Lines dealt out once are over 2 MB. Files are deleted in the background.
    until = time.time() + 30
    while shuffle_mb(spark) - before > 0.5 and time.time() < until:
        time.sleep(0.2)
    assert shuffle_mb(spark) - before < 0.5


@pytest.mark.parametrize("a, b", [(1.0, 1 + 0.9e-5), (1.0, 1 + 1.1e-5), (0.0, 0.9e-8), (0.0, 1.1e-8), (-2.0, 2.0)])
def test_tolerance_is_that_of_pandas(spark, a, b):
    try:
        pd.testing.assert_frame_equal(pd.DataFrame({"x": [a]}), pd.DataFrame({"x": [b]}))
        expected = 0
    except AssertionError:
        expected = 1
    assert compare(spark, [(1, 1, a, "s")], [(1, 1, b, "s")])["ratio"].mismatched == expected


@pytest.fixture(scope="module")
def groups(spark):
    rows = [(i, i % 2 * 300 + i % 5, 1 + i % 2 * 50, 10.0 + i % 2 * 9000, 0.1, 5.0) for i in range(200)]
    return spark.createDataFrame(
        rows, "customer_id int, recency int, frequency int, monetary double, return_ratio double, avg_order_value double"
    )


def test_clusters_separate_groups_and_survive_saving(spark, groups, tmp_path):
    model = fit_clusters(groups, k=2)
    assigned = {row.customer_id: row.cluster for row in assign_clusters(model, groups).collect()}
    assert len({assigned[i] for i in range(0, 200, 2)}) == 1 and assigned[0] != assigned[1]
    assert silhouette(model, groups) > 0.9
    save_model(model, str(tmp_path / "model"))
    save_model(model, str(tmp_path / "model"))
    again = assign_clusters(load_model(str(tmp_path / "model")), groups)
    assert {row.customer_id: row.cluster for row in again.collect()} == assigned
    refit = assign_clusters(fit_clusters(groups, k=2), groups)
    assert {row.customer_id: row.cluster for row in refit.collect()} == assigned


def test_fixed_point_of_clusters(spark):
    rows = [(i, i % 7 + 40 * (i % 2), i % 5 + 1, 100.0 * (i % 2) + i % 3, 0.1 * (i % 3), 10.0 + i % 4) for i in range(300)]
    features = stage(
        spark.createDataFrame(
            rows, "customer_id int, recency int, frequency long, monetary double, return_ratio double, avg_order_value double"
        )
    )
    model = fit_clusters(features, k=3, max_iterations=200, tolerance=1e-9)
    found = {row.condition: (row.checked, row.violations) for row in check_fixed_point(model, features).collect()}
    assert found == {"nearest centre": (300, 0), "mean of members": (15, 0)}
    # Other customers than those that were fitted move the means.
    shifted = features.filter("customer_id < 150").withColumn("recency", F.col("recency") + F.col("customer_id"))
    off = {row.condition: row.violations for row in check_fixed_point(model, shifted).collect()}
    assert off["mean of members"] > 0 and off["nearest centre"] == 0
