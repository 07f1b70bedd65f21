"""Sketches against exact figures, for any span of months."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators import sketches
from tillroll.staging import stage

COLUMNS = ["price", "code", "nothing"]


@pytest.fixture(scope="module")
def sales(spark):
    month = F.when(F.col("id") % 3 == 0, 14).otherwise(F.col("id") % 30)
    df = spark.range(0, 60_000, 1, 6).select(
        (2009 + F.floor(month / 12)).cast("int").alias("year"),
        (month % 12 + 1).cast("int").alias("month"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.hash("id"), F.lit(20_000)) / 7).alias("price"),
        F.pmod(F.xxhash64("id"), F.lit(9_000)).cast("string").alias("code"),
        F.lit(None).cast("double").alias("nothing"),
    )
    return stage(df)


@pytest.mark.parametrize("first, last", [((2009, 1), (2011, 6)), ((2010, 3), (2010, 3)), ((2009, 12), (2010, 2))])
def test_merged_sketches_keep_their_bounds(sales, first, last):
    stored = stage(sketches.monthly_sketches(sales, COLUMNS))
    assert stored.count() == 20 * len(COLUMNS)
    summary = stage(sketches.sketched_summary(stored, first, last))
    inside = sales.filter((F.col("year") * 12 + F.col("month")).between(first[0] * 12 + first[1], last[0] * 12 + last[1]))
    found = {row.column: row for row in sketches.check_sketches(inside, summary, COLUMNS).collect()}
    assert set(found) == {"price", "code"}
    assert all(row.distinct_within and row.ranks_within for row in found.values())
    assert found["price"].present == inside.filter("price IS NOT NULL").count()
    by_name = {row.column: row for row in summary.collect()}
    assert by_name["code"].q50 is None and by_name["price"].q25 < by_name["price"].q50 < by_name["price"].q75


def test_checks_notice_a_wrong_sketch(sales):
    stored = sketches.monthly_sketches(sales, COLUMNS)
    summary = stage(sketches.sketched_summary(stored, (2009, 1), (2009, 2)))
    found = sketches.check_sketches(sales.filter("price < 1000 OR price IS NULL"), summary, COLUMNS)
    assert not any(row.ranks_within and row.distinct_within for row in found.filter("column = 'price'").collect())


def test_no_month_gives_no_row(sales):
    assert sketches.sketched_summary(sketches.monthly_sketches(sales, COLUMNS), (1990, 1), (1990, 2)).count() == 0
