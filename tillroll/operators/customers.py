"""Per-customer measures, taken from one pass over the transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import elapsed_days, elapsed_seconds, ratio
from tillroll.operators.ordering import previous_rows
from tillroll.staging import stage


def invoice_totals(transactions: DataFrame) -> DataFrame:
    """One row per customer and invoice.

    Grouping by invoice first spreads a customer with very many rows over the tasks
    and leaves a plain count where a distinct count would be needed.
    """
    revenue = F.col("quantity") * F.col("price")
    return (
        transactions.filter(F.col("customer_id").isNotNull())
        .withColumn("revenue", revenue)
        .groupBy("customer_id", "invoice")
        .agg(
            F.min("invoice_date").alias("first_date"),
            F.max("invoice_date").alias("last_date"),
            F.sum("revenue").alias("revenue"),
            F.sum(F.greatest("revenue", F.lit(0))).alias("sales"),
            F.sum(-F.least("revenue", F.lit(0))).alias("returns"),
        )
    )


def customer_core(transactions: DataFrame) -> DataFrame:
    """Last purchase, distinct invoices, revenue, sales and returns per customer."""
    return (
        invoice_totals(transactions)
        .groupBy("customer_id")
        .agg(
            F.max("last_date").alias("last_purchase"),
            F.count("invoice").alias("frequency"),
            F.sum("revenue").alias("monetary"),
            F.sum("sales").alias("total_sales"),
            F.sum("returns").alias("total_returns"),
        )
    )


def add_recency(core: DataFrame) -> DataFrame:
    """Whole days from a customer's last purchase to the latest purchase of all."""
    latest = core.agg(F.max("last_purchase")).scalar()
    return core.withColumn("recency", elapsed_days(latest, F.col("last_purchase")))


def add_return_ratio(core: DataFrame) -> DataFrame:
    """Returns as a share of sales; 0 for a customer without sales."""
    share = ratio(F.col("total_returns"), F.col("total_sales"))
    return core.withColumn("return_ratio", F.coalesce(share, F.lit(0.0)))


def add_average_order_value(core: DataFrame) -> DataFrame:
    return core.withColumn("avg_order_value", ratio(F.col("monetary"), F.col("frequency")))


def interpurchase_days(transactions: DataFrame) -> DataFrame:
    """Mean days between a customer's consecutive invoices; null for a single one.

    The gaps between sorted dates add up to last minus first, so the mean needs no
    sort. An invoice counts from its earliest row.
    """
    gap = elapsed_seconds(F.max("first_date"), F.min("first_date")).cast("double")
    return (
        invoice_totals(transactions)
        .groupBy("customer_id")
        .agg((gap / 86400 / F.nullif(F.count(F.lit(1)) - 1, F.lit(0))).alias("avg_interpurchase_days"))
    )


def invoice_gaps(transactions: DataFrame) -> DataFrame:
    """Every invoice of a customer with the days since the one before, null for the first.

    An invoice counts from its earliest row; invoices of one time go by number.
    """
    invoices = invoice_totals(transactions).select("customer_id", "invoice", F.col("first_date").alias("invoice_date"))
    ordered = previous_rows(invoices, "customer_id", ["invoice_date", "invoice"], ["invoice_date"])
    gap = elapsed_seconds(F.col("invoice_date"), F.col("previous_invoice_date")).cast("double") / 86400
    return ordered.withColumn("gap_days", gap)


def tenure_days(transactions: DataFrame) -> DataFrame:
    """Days from a customer's first purchase to the latest purchase of all, rounded half to even."""
    spans = stage(
        transactions.groupBy("customer_id").agg(
            F.min("invoice_date").alias("first_purchase"), F.max("invoice_date").alias("last_purchase")
        ),
        "spans",
    )
    latest = spans.agg(F.max("last_purchase")).scalar()
    days = elapsed_seconds(latest, F.col("first_purchase")) / 86400
    return spans.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", F.bround(days, 0).cast("bigint").alias("customer_tenure_days")
    )


def customer_revenue(transactions: DataFrame) -> DataFrame:
    known = transactions.filter(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(F.sum("revenue").alias("revenue"))
