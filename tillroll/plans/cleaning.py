"""From raw invoice lines to the processed transaction table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import one_row_each
from tillroll.operators import cleaning as c


def consistent_lines(raw: DataFrame) -> DataFrame:
    """Lines with a price, a customer and a consistent sign, and all their copies."""
    return (
        raw.transform(c.keep_positive_prices)
        .transform(c.set_types)
        .transform(c.strip_descriptions)
        .transform(c.keep_known_customers)
        .transform(c.drop_contradictory_cancellations)
    )


def valid_lines(raw: DataFrame) -> DataFrame:
    """Lines with a price, a customer and a consistent sign; copies removed."""
    return raw.transform(consistent_lines).transform(c.drop_exact_duplicates)


def product_lines(raw: DataFrame) -> DataFrame:
    """Valid lines that sell or return a product, with revenue.

    The product rules look at one row at a time, and padding does not matter to them,
    so they commute with the other steps. They are put first to keep their rows out of
    the shuffle that removes copies.
    """
    return (
        raw.transform(c.drop_non_product_codes)
        .transform(c.drop_non_product_text)
        .transform(valid_lines)
        .transform(c.add_revenue)
    )


def balanced_lines(raw: DataFrame) -> DataFrame:
    """Product lines of customers with a balance of 0 or more.

    The rules of ``product_lines``, with lines dealt out by customer before copies are
    removed: both sides of the balance rule read that one shuffle of whole rows.
    """
    return (
        raw.transform(c.drop_non_product_codes)
        .transform(c.drop_non_product_text)
        .transform(consistent_lines)
        .transform(c.deal_by_customer)
        .transform(c.drop_exact_duplicates)
        .transform(c.add_revenue)
        .transform(c.drop_negative_balances)
    )


def clean_transactions(raw: DataFrame) -> DataFrame:
    """The processed table: product lines of customers with a balance of 0 or more."""
    return raw.transform(balanced_lines).transform(c.add_calendar)


FUNNEL_STAGES = [
    "raw",
    "positive_price",
    "known_customer",
    "consistent_cancellation",
    "distinct",
    "product_code",
    "product_text",
    "non_negative_balance",
]


def cleaning_funnel(raw: DataFrame) -> DataFrame:
    """Rows left after each cleaning step, from one scan.

    Equal rows are counted into groups; a group knows how many of its rows pass each
    rule. Groups are then added up per customer to find the balance, and customers
    to the totals.
    """
    typed = raw.transform(c.set_types).transform(c.strip_descriptions)
    groups = typed.groupBy(*typed.columns).agg(F.count(F.lit(1)).alias("copies"))

    priced = c.positive_price()
    known = priced & c.known_customer()
    consistent = known & ~c.contradictory_cancellation()
    product_code = consistent & ~c.non_product_code()
    product_text = product_code & ~c.non_product_text()

    per_customer = groups.groupBy("customer_id").agg(
        F.sum("copies").alias("raw"),
        F.sum(F.when(priced, F.col("copies"))).alias("positive_price"),
        F.sum(F.when(known, F.col("copies"))).alias("known_customer"),
        F.sum(F.when(consistent, F.col("copies"))).alias("consistent_cancellation"),
        F.count_if(consistent).alias("distinct"),
        F.count_if(product_code).alias("product_code"),
        F.count_if(product_text).alias("product_text"),
        F.sum(F.when(product_text, F.col("quantity") * F.col("price"))).alias("balance"),
    )
    in_debt = F.coalesce(F.col("balance") < 0, F.lit(False))
    totals = per_customer.withColumn(
        "non_negative_balance", F.when(~in_debt, F.col("product_text"))
    ).agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in FUNNEL_STAGES])
    rows = [
        [F.lit(step).alias("step"), F.lit(name).alias("stage"), F.col(name).alias("rows")]
        for step, name in enumerate(FUNNEL_STAGES)
    ]
    return totals.select(one_row_each(*rows))
