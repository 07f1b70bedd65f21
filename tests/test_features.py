from decimal import Decimal

import pytest
from frames import line

from tillroll.operators.customers import (
    add_average_order_value,
    add_recency,
    add_return_ratio,
    customer_core,
    interpurchase_days,
    tenure_days,
)
from tillroll.plans.features import customer_features, customer_features_from_raw, customer_features_joined
from tillroll.sources.order_tables import invoice_lines
from tillroll.sources.schemas import FEATURE_COLUMNS

SMALL = "/root/testdata/sf0.001"


def by_customer(df):
    return {row.customer_id: row for row in df.collect()}


def test_core_counts_invoices_and_keeps_returns(raw_frame):
    df = raw_frame(
        line(invoice="1", price="2.00", quantity=3),
        line(invoice="1", price="1.00", quantity=1),
        line(invoice="C2", price="2.00", quantity=-1, when="2010-12-05 09:00:00"),
        line(invoice=None, price="1.00", quantity=1),
        line(customer_id=None, invoice="9"),
    )
    core = customer_core(df).first()
    assert (core.frequency, core.monetary, core.total_sales, core.total_returns) == (
        2,
        Decimal("6.00"),
        Decimal("8.00"),
        Decimal("2.00"),
    )
    assert core.last_purchase.isoformat() == "2010-12-05T09:00:00"


def test_recency_counts_elapsed_days(raw_frame):
    df = raw_frame(
        line(customer_id=1, when="2010-12-01 12:00:00"),
        line(customer_id=2, when="2010-12-02 11:59:00"),
        line(customer_id=3, when="2010-12-03 11:59:00"),
    )
    rows = by_customer(add_recency(customer_core(df)))
    assert [rows[c].recency for c in (1, 2, 3)] == [1, 1, 0]


def test_ratio_without_sales_is_zero(raw_frame):
    df = raw_frame(
        line(customer_id=1, quantity=-2, price="1.00"),
        line(customer_id=2, invoice="1", quantity=4, price="1.00"),
        line(customer_id=2, invoice="C2", quantity=-1, price="1.00"),
    )
    rows = by_customer(add_average_order_value(add_return_ratio(customer_core(df))))
    assert rows[1].return_ratio == 0.0 and rows[1].avg_order_value == -2.0
    assert rows[2].return_ratio == 0.25 and rows[2].avg_order_value == 1.5


def test_gaps_and_tenure(raw_frame):
    df = raw_frame(
        line(customer_id=1, invoice="1", when="2010-12-01 00:00:00"),
        line(customer_id=1, invoice="2", when="2010-12-02 12:00:00"),
        line(customer_id=1, invoice="2", when="2010-12-09 00:00:00"),
        line(customer_id=1, invoice="3", when="2010-12-05 00:00:00"),
        line(customer_id=2, invoice="4", when="2010-12-06 12:00:00"),
        line(customer_id=3, invoice="5", when="2010-12-07 12:00:00"),
    )
    gaps = by_customer(interpurchase_days(df))
    assert gaps[1].avg_interpurchase_days == 2.0 and gaps[2].avg_interpurchase_days is None
    tenure = by_customer(tenure_days(df))
    # 8 days, then 2.5 and 1.5 days, which round to the even neighbour.
    assert [tenure[c].customer_tenure_days for c in (1, 2, 3)] == [8, 2, 2]


@pytest.mark.parametrize("rule", ["ntile", "rank_cut"])
def test_features_by_hand(raw_frame, rule):
    df = raw_frame(
        *[
            line(customer_id=c, invoice=f"{c}-{i}", price="1.00", quantity=c, when=f"2010-12-{10 + c:02} 00:00:00")
            for c in range(1, 11)
            for i in range(c)
        ]
    )
    rows = by_customer(customer_features(df, rule))
    assert list(rows[1].asDict()) == FEATURE_COLUMNS
    assert [rows[c].recency for c in range(1, 11)] == list(range(9, -1, -1))
    assert [rows[c].frequency_score for c in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert [rows[c].recency_score for c in range(1, 11)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]
    assert rows[10].r_f_score == "55" and rows[10].segment == "champions"
    assert rows[1].segment == "hibernating"


def test_fused_features_equal_joined_and_distributed(spark, sliced):
    from tillroll.plans.cleaning import clean_transactions
    from tillroll.staging import stage

    raw = invoice_lines(spark, SMALL)
    fused = sorted(customer_features_from_raw(raw).collect())
    clean = stage(clean_transactions(raw))
    assert fused == sorted(customer_features_joined(clean).collect())
    assert fused == sorted(customer_features(clean).collect())
    assert len(fused) == 133


def test_final_plan_reads_one_narrow_row_per_customer(spark):
    features = customer_features_from_raw(invoice_lines(spark, SMALL))
    features.collect()
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    assert "lineitem" not in plan
