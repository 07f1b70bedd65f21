"""Revenue and activity over time, product and country."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import ratio, year_month
from tillroll.staging import stage


def revenue_by(df: DataFrame, *keys: str) -> DataFrame:
    """Summed revenue per key combination; rows with a null key are left out."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.sum("revenue").alias("revenue"))


def revenue_by_month(df: DataFrame) -> DataFrame:
    months = revenue_by(df, "year", "month")
    return months.withColumn("year_month", year_month(F.col("year"), F.col("month"))).orderBy("year_month")


def revenue_pivot(df: DataFrame) -> DataFrame:
    """Years as rows, months m1..m12 as columns; null where nothing was sold."""
    months = list(range(1, 13))
    wide = df.groupBy("year").pivot("month", months).agg(F.sum("revenue"))
    return wide.select("year", *[F.col(str(m)).alias(f"m{m}") for m in months])


def top_per_year(totals: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` highest totals of each year; equal totals go by the keys."""
    order = [F.col("revenue").desc_nulls_last(), *[F.col(key).asc() for key in keys]]
    ranked = totals.withColumn("position", F.row_number().over(Window.partitionBy("year").orderBy(*order)))
    return ranked.filter(F.col("position") <= k)


def top_products_by_year(df: DataFrame, k: int = 10) -> DataFrame:
    keys = ["stock_code", "description"]
    return top_per_year(revenue_by(df, "year", *keys), keys, k)


def top_countries_by_year(df: DataFrame, k: int = 5) -> DataFrame:
    return top_per_year(revenue_by(df, "year", "country"), ["country"], k)


def country_share(df: DataFrame, k: int = 5) -> DataFrame:
    """Share of the top countries in the revenue they make up, and in that of the year."""
    year = Window.partitionBy("year")
    totals = revenue_by(df, "year", "country").withColumn("year_revenue", F.sum("revenue").over(year))
    return (
        top_per_year(totals, ["country"], k)
        .withColumn("share_of_top", ratio(F.col("revenue"), F.sum("revenue").over(year)))
        .withColumn("share_of_year", ratio(F.col("revenue"), F.col("year_revenue")))
        .drop("year_revenue")
    )


def customer_country_counts(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` customer and country pairs with the most rows."""
    counts = df.dropna(subset=["customer_id", "country"]).groupBy("customer_id", "country")
    return (
        counts.agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "customer_id", "country")
        .limit(k)
    )


def daily_counts(df: DataFrame) -> DataFrame:
    """Rows per calendar day from the first to the last day, 0 where there are none.

    The counts, one row per active day, are staged: the calendar needs their ends first.
    """
    days = stage(
        df.filter(F.col("invoice_date").isNotNull())
        .groupBy(F.to_date("invoice_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n")),
        "days",
    )
    calendar = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).select(
        F.explode(F.expr("sequence(first, last, interval 1 day)")).alias("day")
    )
    return calendar.join(days, "day", "left").select(
        "day", F.year("day").alias("year"), F.coalesce("n", F.lit(0)).alias("n")
    )


def zero_days(daily: DataFrame) -> DataFrame:
    """Days without a transaction."""
    return daily.filter("n = 0").select("day")


def zero_day_report(daily: DataFrame, k: int = 20) -> DataFrame:
    """The first ``k`` days without a transaction, and how many there are in all."""
    empty = zero_days(daily)
    total = empty.agg(F.count(F.lit(1))).scalar()
    return empty.orderBy("day").limit(k).withColumn("zero_days", total)
