"""Cleaning rules. Each takes and returns a frame, for use with ``df.transform``."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import is_true, strip_whitespace
from tillroll.staging import stage

# Stock codes and description phrases that mark lines which are not
# sales of a product.
NON_PRODUCT_CODES = [
    "POST",
    "DOT",
    "M",
    "D",
    "C2",
    "S",
    "AMAZONFEE",
    "BANK CHARGES",
    "PADS",
    "CRUK",
]
NON_PRODUCT_PHRASES = [
    "manual",
    "postage",
    "dotcom postage",
    "bank charges",
    "amazon fee",
    "discount",
    "cruk commission",
    "adjust",
    "carriage",
]


def positive_price() -> Column:
    return is_true(F.col("price") > 0)


def known_customer() -> Column:
    return F.col("customer_id").isNotNull()


def contradictory_cancellation() -> Column:
    """A cancellation invoice (leading C) that nevertheless adds units."""
    return is_true(F.col("invoice").startswith("C") & (F.col("quantity") > 0))


def non_product_code() -> Column:
    return is_true(F.col("stock_code").isin(NON_PRODUCT_CODES))


def non_product_text() -> Column:
    """The description holds one of the phrases; padding around it makes no difference."""
    return is_true(F.lower("description").rlike("|".join(map(re.escape, NON_PRODUCT_PHRASES))))


def set_types(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "invoice_date": F.col("invoice_date").cast("timestamp_ntz"),
            "customer_id": F.col("customer_id").cast("int"),
        }
    )


def strip_descriptions(df: DataFrame) -> DataFrame:
    return df.withColumn("description", strip_whitespace(F.col("description")))


def keep_positive_prices(df: DataFrame) -> DataFrame:
    return df.filter(positive_price())


def keep_known_customers(df: DataFrame) -> DataFrame:
    return df.filter(known_customer())


def list_contradictory_cancellations(df: DataFrame) -> DataFrame:
    return df.filter(contradictory_cancellation())


def drop_contradictory_cancellations(df: DataFrame) -> DataFrame:
    return df.filter(~contradictory_cancellation())


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One row of each group of equal rows; copies collapse before the shuffle."""
    return df.dropDuplicates()


#: Parts into which the rows of a customer are dealt.
PARTS = 8
#: Name of the column with the part while rows lie so.
PART = "_customer_part"


def deal_by_customer(df: DataFrame) -> DataFrame:
    """Deal rows out by customer and by a part, 0 to 7, that invoice and product decide.

    Equal rows meet, and so does all of a customer but for its parts: one shuffle serves the
    removal of copies and the balance rule, and a customer that holds much of the table is
    spread over as many tasks as there are parts.
    """
    part = F.pmod(F.xxhash64("invoice", "stock_code"), F.lit(PARTS)).cast("int")
    return df.withColumn(PART, part).repartition("customer_id", PART)


def drop_non_product_codes(df: DataFrame) -> DataFrame:
    return df.filter(~non_product_code())


def drop_non_product_text(df: DataFrame) -> DataFrame:
    return df.filter(~non_product_text())


def add_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.col("quantity") * F.col("price"))


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({"year": F.year("invoice_date"), "month": F.month("invoice_date")})


def drop_negative_balances(df: DataFrame) -> DataFrame:
    """Remove every row of customers whose revenue adds up to less than 0.

    ``df`` is evaluated twice up to its last shuffle, which both sides of the join read.
    The list of ids is dealt out anew, so that both sides of a join without broadcast are
    plain exchanges and adaptive execution can split a customer that holds much of the table.
    Rows from ``deal_by_customer`` stay where they are: sums of a customer's parts are added
    up, and the ids go to each part. The column of the part is dropped.
    """
    dealt = PART in df.columns
    known, keys = df.filter(known_customer()), ["customer_id"]
    if dealt:
        keys = ["customer_id", PART]
        known = known.groupBy(*keys).agg(F.sum("revenue").alias("revenue"))
    balances = known.groupBy("customer_id").agg(F.sum("revenue").alias("balance"))
    in_debt = balances.filter("balance < 0").select("customer_id").hint("rebalance")
    if dealt:
        in_debt = in_debt.withColumn(PART, F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return df.join(in_debt, keys, "left_anti").select(*[name for name in df.columns if name != PART])


def list_returns(df: DataFrame) -> DataFrame:
    """Rows with a negative quantity."""
    return df.filter(F.col("quantity") < 0)


def list_stock_code(df: DataFrame, code: str) -> DataFrame:
    return df.filter(F.col("stock_code") == code)


def list_duplicate_rows(df: DataFrame) -> DataFrame:
    """Every member of a group of equal rows, numbered and sorted by all columns.

    Groups are counted first, so copies never travel. A group is expanded in two
    steps of about the square root of its size with a shuffle between them: no task
    holds a longer list than that, and a huge group is spread over the tasks. The
    copy number makes rows unique, so that the sort can split the group as well.
    """
    columns = df.columns
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    stride = F.ceil(F.sqrt("copies"))
    starts = groups.withColumn("stride", stride).withColumn(
        "start", F.explode(F.expr("sequence(1L, copies, stride)"))
    )
    members = starts.repartition(*columns, "start").withColumn(
        "copy_no", F.explode(F.expr("sequence(start, least(start + stride - 1, copies))"))
    )
    order = [F.col(name).asc_nulls_last() for name in columns]
    return members.select(*columns, "copy_no").orderBy(*order, "copy_no")
