import pandas as pd
import pytest
from hypothesis import given
from hypothesis import settings as budget
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillroll.operators.ordering import rank_rows, running_total
from tillroll.operators.scoring import SEGMENTS, add_scores, last_ranks, segment
from tillroll.staging import stage

METRICS = ["recency", "frequency", "monetary"]


def buckets(ends, n):
    return [1 + sum(end < rank for end in ends) for rank in range(1, n + 1)]


def ntile(n, k):
    sizes = [n // k + (1 if b < n % k else 0) for b in range(k)]
    return [b + 1 for b, size in enumerate(sizes) for _ in range(size)]


@given(st.integers(1, 400), st.integers(1, 12))
@budget(max_examples=300, deadline=None)
def test_ntile_ends_fill_buckets_evenly(n, k):
    assert buckets(last_ranks(n, k, "ntile"), n) == ntile(n, k)


@given(st.integers(2, 7000))
@budget(max_examples=300, deadline=None)
def test_rank_cut_ends_equal_a_quantile_cut(n):
    cut = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert buckets(last_ranks(n, 5, "rank_cut"), n) == cut.tolist()


def test_rules_differ_at_three_ranks_of_5847():
    filled, cut = (buckets(last_ranks(5847, 5, rule), 5847) for rule in ("ntile", "rank_cut"))
    assert [r for r, (a, b) in enumerate(zip(filled, cut), 1) if a != b] == [2340, 3509, 4678]


def test_rank_cut_needs_two_rows(spark):
    one = spark.createDataFrame([(1, 1, 1, 1)], ["customer_id", *METRICS])
    with pytest.raises(ValueError):
        add_scores(one, rule="rank_cut")
    assert add_scores(one).select("recency_score", "monetary_score").first() == (5, 1)
    with pytest.raises(ValueError):
        last_ranks(10, 5, "other")


def customers(spark, n):
    """Ties of every kind: a third on one value, few values, all different."""
    df = spark.range(n).select(
        F.col("id").cast("int").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.pmod(F.hash("id"), F.lit(50))).cast("int").alias("recency"),
        F.when(F.col("id") % 10 < 9, 1).otherwise(F.pmod(F.hash("id"), F.lit(7))).cast("bigint").alias("frequency"),
        (F.pmod(F.hash("id"), F.lit(10_000_000)) / 100).cast("decimal(31,2)").alias("monetary"),
    )
    return stage(df)


def builtin_scores(df):
    def tile(metric):
        return F.ntile(5).over(Window.orderBy(metric, "customer_id"))

    return df.withColumns(
        {"recency_score": 6 - tile("recency"), "frequency_score": tile("frequency"), "monetary_score": tile("monetary")}
    )


@pytest.mark.parametrize("n", [1, 3, 4, 5, 7, 23, 5003])
def test_distributed_scores_equal_builtin_ntile(spark, sliced, n):
    df = customers(spark, n)
    assert sorted(add_scores(df).collect()) == sorted(builtin_scores(df).collect())


def test_scores_of_one_slice_equal_builtin_ntile(spark):
    df = customers(spark, 1001)
    assert sorted(add_scores(df).collect()) == sorted(builtin_scores(df).collect())


@pytest.mark.parametrize("missing", [1, 2, 7])
def test_null_metrics_come_last(spark, sliced, missing):
    df = stage(
        customers(spark, 10).withColumn("monetary", F.when(F.col("customer_id") > missing, F.col("monetary")))
    )
    tile = F.ntile(5).over(Window.orderBy(F.col("monetary").asc_nulls_last(), "customer_id"))
    ours = add_scores(df).select("customer_id", "monetary_score")
    assert sorted(ours.collect()) == sorted(df.select("customer_id", tile).collect())


def test_scores_of_no_rows(spark):
    assert add_scores(customers(spark, 0)).count() == 0


def test_distributed_ranks_equal_row_number(spark, sliced):
    df = customers(spark, 4001)
    ranked = rank_rows(df, "customer_id", METRICS)
    for metric in METRICS:
        plain = df.select(
            "customer_id", F.row_number().over(Window.orderBy(metric, "customer_id")).cast("bigint").alias("rank")
        )
        ours = ranked.filter(F.col("column") == metric).select("customer_id", "rank")
        assert ours.count() == 4001 and ours.exceptAll(plain).count() == 0


def test_distributed_order_uses_several_slices_and_no_single_task(spark, sliced):
    df = customers(spark, 4001)
    total = running_total(df.select("customer_id", F.lit("m").alias("column"), "recency"), ["column"], ["recency", "customer_id"])
    total.collect()
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert total.count() == 4001


def test_running_total_with_weights_and_groups(spark, sliced):
    rows = [(g, v, (v * 7) % 5 + 1) for g in ("a", "b") for v in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, n bigint")
    found = {(r.g, r.v): (r.upto, r.total) for r in running_total(df, ["g"], ["v"], "n").collect()}
    for g in ("a", "b"):
        upto = 0
        total = sum(n for h, _, n in rows if h == g)
        for _, v, n in [row for row in rows if row[0] == g]:
            upto += n
            assert found[g, v] == (upto, total)


def test_segments_cover_the_grid_once(spark):
    grid = spark.createDataFrame([(r, f) for r in range(1, 6) for f in range(1, 6)], "r int, f int")
    found = {(row.r, row.f): row.s for row in grid.select("r", "f", segment("r", "f").alias("s")).collect()}
    for cell in found:
        names = [name for r, f, name in SEGMENTS if r[0] <= cell[0] <= r[1] and f[0] <= cell[1] <= f[1]]
        assert names == [found[cell]]
    assert found[5, 5] == "champions" and found[3, 3] == "need_attention" and found[1, 5] == "cant_lose"
    assert found[4, 3] == found[5, 2] == "potential_loyalists" and found[3, 5] == found[4, 4] == "loyal_customers"
    assert found[4, 1] == "promising" and found[5, 1] == "new_customers" and found[2, 3] == "at_risk"
    outside = spark.createDataFrame([(6, 1)], "r int, f int").select(segment("r", "f").alias("s"))
    assert outside.first().s is None
