from decimal import Decimal

import pytest
from frames import line, settings

from tillroll.functions.columns import strip_whitespace
from tillroll.operators import cleaning
from tillroll.plans.cleaning import balanced_lines, clean_transactions, cleaning_funnel, product_lines, valid_lines
from tillroll.sources.order_tables import invoice_lines
from tillroll.staging import stage
from pyspark.sql import functions as F


def values(df, column):
    return sorted((row[column] for row in df.collect()), key=str)


def test_price_must_be_positive_and_present(raw_frame):
    df = raw_frame(*[line(stock_code=str(i), price=p) for i, p in enumerate(["0.01", "0.00", "-1.00", None])])
    assert values(df.transform(cleaning.keep_positive_prices), "stock_code") == ["0"]


def test_cancellation_rule_keeps_nulls(raw_frame):
    df = raw_frame(
        line(invoice="C1", quantity=5, stock_code="drop"),
        line(invoice="C1", quantity=-5, stock_code="return"),
        line(invoice="1", quantity=5, stock_code="sale"),
        line(invoice=None, quantity=5, stock_code="no invoice"),
        line(invoice="C1", quantity=None, stock_code="no quantity"),
        line(invoice="c1", quantity=5, stock_code="lower case"),
    )
    kept = values(df.transform(cleaning.drop_contradictory_cancellations), "stock_code")
    assert kept == ["lower case", "no invoice", "no quantity", "return", "sale"]
    assert values(df.transform(cleaning.list_contradictory_cancellations), "stock_code") == ["drop"]


def test_product_rules_keep_nulls_and_case(raw_frame):
    df = raw_frame(
        line(stock_code="POST", description="a"),
        line(stock_code="post", description="b"),
        line(stock_code=None, description="c"),
        line(stock_code="1", description=None),
        line(stock_code="2", description="Next Day CARRIAGE "),
        line(stock_code="3", description="manually made"),
        line(stock_code="4", description="man ual"),
    )
    by_code = df.transform(cleaning.drop_non_product_codes)
    assert values(by_code, "stock_code") == ["1", "2", "3", "4", None, "post"]
    by_text = by_code.transform(cleaning.drop_non_product_text)
    assert values(by_text, "stock_code") == ["1", "4", None, "post"]


@pytest.mark.parametrize("padded", [" a b ", "\ta b\n", " a b　", " a b\x1f", "a b"])
def test_strip_removes_any_whitespace(spark, padded):
    df = spark.createDataFrame([(padded,)], "d string").select(strip_whitespace(F.col("d")).alias("d"))
    assert df.first().d == padded.strip() == "a b"


def test_strip_comes_before_the_removal_of_copies(raw_frame):
    df = raw_frame(line(description="mug "), line(description=" mug"), line(description=None), line(description=None))
    assert values(valid_lines(df), "description") == [None, "mug"]


def test_balance_keeps_zero_and_drops_below(raw_frame):
    df = raw_frame(
        line(customer_id=1, quantity=2, price="1.00"),
        line(customer_id=1, quantity=-2, price="1.00"),
        line(customer_id=2, quantity=1, price="0.01"),
        line(customer_id=2, quantity=-1, price="0.02"),
        line(customer_id=3, quantity=1),
    )
    clean = clean_transactions(df)
    assert values(clean, "customer_id") == [1, 1, 3]
    assert clean.filter("customer_id = 3").first().revenue == Decimal("2.55")


def test_balance_with_long_list_and_hot_customer(spark):
    """Neither a broadcast nor a hot key is needed for the right answer."""
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).cast("int").alias("customer_id"),
        F.when((F.col("id") % 997) % 2 == 0, -1).otherwise(1).cast("decimal(20,2)").alias("revenue"),
    )
    rows = stage(rows)
    expected = rows.toPandas()
    totals = expected.groupby("customer_id")["revenue"].sum()
    expected = expected[~expected.customer_id.isin(totals[totals < 0].index)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = cleaning.drop_negative_balances(rows)
        assert "Broadcast" not in kept._jdf.queryExecution().toString()
        assert kept.count() == len(expected)
        assert set(values(kept.distinct(), "customer_id")) == set(expected.customer_id)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clean_order_of_rules(raw_frame):
    """Product rows decide the balance: a returned postage line does not count."""
    df = raw_frame(line(customer_id=1, price="1.00"), line(customer_id=1, stock_code="POST", quantity=-1, price="9.00"))
    clean = clean_transactions(df).collect()
    assert [(row.stock_code, row.year, row.month) for row in clean] == [("85123", 2010, 12)]


def test_product_lines_equal_the_rules_in_plain_order(raw_frame):
    df = raw_frame(
        line(), line(), line(description=" white heart"), line(description="Manual "), line(stock_code="D"),
        line(price="0.00"), line(customer_id=None), line(invoice="C9", quantity=3),
    )
    plain = (
        valid_lines(df)
        .transform(cleaning.drop_non_product_codes)
        .transform(cleaning.drop_non_product_text)
        .transform(cleaning.add_revenue)
    )
    assert sorted(product_lines(df).collect()) == sorted(plain.collect())
    assert plain.count() == 1


def test_funnel_counts_every_step(raw_frame):
    df = raw_frame(
        line(),
        line(),
        line(price="0.00"),
        line(customer_id=None),
        line(invoice="C5", quantity=4),
        line(stock_code="DOT"),
        line(description="bank charges"),
        line(customer_id=2, quantity=-1),
    )
    counts = [row.rows for row in cleaning_funnel(df).orderBy("step").collect()]
    assert counts == [8, 7, 6, 5, 4, 3, 2, 1]
    assert clean_transactions(df).count() == counts[-1]


def test_duplicates_are_listed_with_multiplicity(raw_frame):
    df = raw_frame(*[line()] * 7, *[line(description=None)] * 2, line(quantity=9))
    listed = cleaning.list_duplicate_rows(df).collect()
    assert [row.copy_no for row in listed] == [1, 2, 3, 4, 5, 6, 7, 1, 2]
    assert [row.description for row in listed] == ["white heart"] * 7 + [None] * 2
    assert df.transform(cleaning.drop_exact_duplicates).count() == 3


def test_a_large_group_of_copies_is_expanded_whole(spark):
    df = spark.range(100_000).select(F.lit("a").alias("x"), F.lit(None).cast("int").alias("y"))
    listed = cleaning.list_duplicate_rows(df)
    assert listed.count() == 100_000
    assert listed.agg(F.count_distinct("copy_no")).first()[0] == 100_000


def test_listings(raw_frame):
    df = raw_frame(line(quantity=-1), line(quantity=0), line(stock_code="C2"))
    assert cleaning.list_returns(df).count() == 1
    assert cleaning.list_stock_code(df, "C2").count() == 1


def test_the_clean_reads_one_shuffle_for_lines_and_balances(spark):
    """Both sides of the balance rule reuse the exchange that removes copies."""
    cleaned = clean_transactions(invoice_lines(spark, "/root/testdata/sf0.001"))
    cleaned.collect()
    plan = cleaned._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and "staged" not in plan


def test_whole_rows_are_shuffled_once(spark, raw_frame):
    """Balances and their ids are shuffled beside the rows; the rows are not for the balance rule."""
    raw = stage(raw_frame(line(), line(), line(customer_id=2, quantity=-1)))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = clean_transactions(raw)._jdf.queryExecution().executedPlan().toString()
    # Either side of the rule lists the one shuffle of the rows; it is run once.
    assert plan.count("REPARTITION_BY_COL") == 2
    assert plan.count("ENSURE_REQUIREMENTS") == 2


def test_a_balance_adds_up_all_parts_of_a_customer(raw_frame):
    lines = [
        line(invoice=invoice, stock_code=code, customer_id=customer, quantity=quantity)
        for customer, debt in ((1, 101), (2, 100), (None, 500))
        for invoice, code, quantity in [
            *((None if i == 5 else str(i), None if i % 7 == 0 else str(i % 40), 1) for i in range(100)),
            ("C1", "r", -debt),
        ]
    ]
    df = raw_frame(*lines, *lines)
    kept = balanced_lines(df)
    assert kept.columns == product_lines(df).columns
    assert values(kept, "customer_id") == [2] * 101
    assert sorted(kept.collect(), key=str) == sorted(cleaning.drop_negative_balances(product_lines(df)).collect(), key=str)
    parts = cleaning.deal_by_customer(df).select("customer_id", cleaning.PART).distinct()
    assert parts.filter("customer_id = 2").count() == cleaning.PARTS


def test_texts_do_not_travel_to_the_orders(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = invoice_lines(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    shuffled = plan.split("Exchange hashpartitioning(l_orderkey")[1].split("\n")[1]
    assert "returned" in shuffled and "description" not in shuffled and "invoice" not in shuffled
