"""Plans that have to hold when one key is a third of the table and nothing is small."""

import pandas as pd
import pytest
from frames import settings
from pyspark.sql import functions as F

from tillroll.operators import cleaning, distributions, profiling, trends
from tillroll.operators.customers import customer_core, invoice_gaps
from tillroll.plans.cleaning import cleaning_funnel
from tillroll.plans.features import customer_features_from_raw
from tillroll.sources.order_tables import invoice_lines
from tillroll.staging import stage

SMALL = "/root/testdata/sf0.001"

# No side is small enough to broadcast, and any partition above a few KB counts as skewed.
LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "8KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "8KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
    # Several map tasks, whose shares of a hot partition can be read apart.
    "spark__sql__files__maxPartitionBytes": "64KB",
    "spark__sql__files__openCostInBytes": "1",
}


@pytest.fixture
def large(spark):
    with settings(spark, **LARGE):
        yield


@pytest.fixture(scope="module")
def hot(spark):
    """Lines of which a third belong to one customer, product and price."""
    third = F.col("id") % 3 == 0
    return stage(
        spark.range(0, 60_000, 1, 8).select(
            F.when(third, 7).otherwise(F.col("id") % 5000).cast("int").alias("customer_id"),
            F.when(third, "hot").otherwise((F.col("id") % 900).cast("string")).alias("stock_code"),
            F.col("id").cast("string").alias("invoice"),
            (F.pmod(F.hash("id"), F.lit(40)) - F.when(third, 0).otherwise(20)).cast("int").alias("quantity"),
            F.when(third, 1).otherwise(F.pmod(F.hash("id"), F.lit(9000)) + 1).cast("decimal(10,2)").alias("price"),
            F.timestamp_seconds(F.col("id") * 1000).cast("timestamp_ntz").alias("invoice_date"),
        )
    ).transform(cleaning.add_revenue)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_balance_join_splits_a_hot_customer(spark, hot, large):
    lines = stage(hot)
    kept, plan = final_plan(cleaning.drop_negative_balances(lines))
    assert "SortMergeJoin(skew=true)" in plan and "Broadcast" not in plan
    frame = lines.select("customer_id", F.col("revenue").cast("double")).toPandas()
    totals = frame.groupby("customer_id").revenue.sum()
    assert len(kept) == frame.customer_id.isin(totals[totals >= -1e-9].index).sum()
    assert len(kept) < len(frame)


def test_rank_join_splits_a_hot_value(spark, hot, large, sliced):
    # Narrow rows of few values compress well, so that a third of them is few bytes here.
    with settings(
        spark,
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1KB",
    ):
        rows, plan = final_plan(distributions.spearman(hot, ["price", "quantity"]))
    assert "SortMergeJoin(skew=true)" in plan and "Broadcast" not in plan
    expected = hot.select(F.col("price").cast("double"), "quantity").toPandas().corr(method="spearman")
    assert {row.column: row.quantity for row in rows}["price"] == pytest.approx(expected.loc["price", "quantity"])


def test_hot_customer_is_spread_by_invoice(hot):
    rows, plan = final_plan(customer_core(hot))
    assert "hashpartitioning(customer_id#" in plan and ", invoice#" in plan
    core = {row.customer_id: row for row in rows}
    frame = hot.select("customer_id", "invoice", F.col("revenue").cast("double")).toPandas()
    assert core[7].frequency == (frame.customer_id == 7).sum() >= 20_000
    assert float(core[7].monetary) == pytest.approx(frame[frame.customer_id == 7].revenue.sum())
    assert len(core) == frame.customer_id.nunique()


def test_gaps_of_a_hot_customer_cross_slices(spark, hot, large, sliced):
    extra = hot.filter("customer_id < 9").withColumn("quantity", F.lit(1))
    rows, plan = final_plan(invoice_gaps(hot.unionByName(extra)))
    # Windows go by customer and slice, so a third of the rows is no task of its own.
    assert "slice#" in plan.split("Window [")[1].split("\n")[0]
    found = {(row.customer_id, row.invoice): (row.previous_invoice_date, row.gap_days) for row in rows}
    frame = hot.select("customer_id", "invoice", "invoice_date").toPandas().sort_values(["customer_id", "invoice_date", "invoice"])
    frame["previous"] = frame.groupby("customer_id").invoice_date.shift()
    assert len(found) == len(frame) == len(rows)
    for row in frame.itertuples():
        previous, gap = found[row.customer_id, row.invoice]
        if row.previous is pd.NaT:
            assert previous is None and gap is None
        else:
            assert previous == row.previous and gap == pytest.approx((row.invoice_date - row.previous).total_seconds() / 86400)


def test_only_needed_columns_are_read(spark):
    plan = customer_core(stage(invoice_lines(spark, SMALL)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    schema = text.split("ReadSchema: ")[1]
    assert "country" not in schema and "description" not in schema and "stock_code" not in schema
    assert "IsNotNull(customer_id)" in text


@pytest.mark.parametrize(
    "build",
    [cleaning_funnel, profiling.dataset_overview, profiling.null_profile, profiling.sign_audit],
    ids=lambda build: build.__name__,
)
def test_audits_scan_once(spark, build):
    raw = stage(invoice_lines(spark, SMALL))
    _, plan = final_plan(build(raw))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_top_lists_are_cut_before_the_shuffle(spark):
    raw = stage(invoice_lines(spark, SMALL))
    lines = raw.transform(cleaning.add_revenue).transform(cleaning.add_calendar)
    for df in (trends.top_products_by_year(lines), profiling.top_values(raw)):
        _, plan = final_plan(df)
        assert "Partial" in plan.split("WindowGroupLimit")[2]
    for df in (profiling.priciest_products(raw), profiling.extreme_quantities(raw)):
        assert "TakeOrderedAndProject" in final_plan(df)[1]


def test_features_do_not_depend_on_join_strategy(spark, large, sliced):
    features = customer_features_from_raw(invoice_lines(spark, SMALL))
    large_plan = sorted(features.collect())
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="10MB", spark__tillroll__singleTaskRows="200000"):
        assert large_plan == sorted(customer_features_from_raw(invoice_lines(spark, SMALL)).collect())
