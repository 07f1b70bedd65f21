from decimal import Decimal

import pytest
from frames import line

from tillroll.operators import trends
from tillroll.operators.cleaning import add_calendar, add_revenue
from tillroll.operators.profiling import distinct_values


@pytest.fixture
def sales(raw_frame):
    df = raw_frame(
        line(when="2009-12-01 10:00:00", price="1.00", quantity=2),
        line(when="2009-12-01 23:59:59", price="1.00", quantity=1, country="Spain"),
        line(when="2010-01-01 00:00:00", price="5.00", quantity=1, description=None),
        line(when="2010-01-04 00:00:00", price="3.00", quantity=1, stock_code="b"),
        line(when="2010-10-04 00:00:00", price="3.00", quantity=1, stock_code="a", country="Spain"),
        line(when="2010-10-05 00:00:00", price="9.00", quantity=-1, stock_code="c", country="Italy"),
    )
    return df.transform(add_revenue).transform(add_calendar)


def test_revenue_by_year_and_month(sales):
    assert {r.year: r.revenue for r in trends.revenue_by(sales, "year").collect()} == {
        2009: Decimal("3.00"),
        2010: Decimal("2.00"),
    }
    assert [r.year_month for r in trends.revenue_by_month(sales).collect()] == ["2009-12", "2010-01", "2010-10"]


def test_pivot_leaves_missing_months_null(sales):
    rows = {r.year: r for r in trends.revenue_pivot(sales).collect()}
    assert rows[2009].m12 == Decimal("3.00") and rows[2009].m1 is None
    assert rows[2010].m1 == Decimal("8.00") and rows[2010].m10 == Decimal("-6.00") and rows[2010].m12 is None


def test_products_without_description_are_left_out_and_ties_go_by_key(sales):
    rows = trends.top_products_by_year(sales, 2).filter("year = 2010").orderBy("position").collect()
    assert [(r.position, r.stock_code) for r in rows] == [(1, "a"), (2, "b")]
    plan = trends.top_products_by_year(sales, 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_country_shares(sales):
    rows = {(r.year, r.country): r for r in trends.country_share(sales, 2).collect()}
    assert set(rows) == {(2009, "France"), (2009, "Spain"), (2010, "France"), (2010, "Spain")}
    assert rows[2009, "France"].share_of_top == rows[2009, "France"].share_of_year == 2 / 3
    assert rows[2010, "France"].share_of_top == 8 / 11 and rows[2010, "France"].share_of_year == 4.0


def test_calendar_has_no_gaps(sales):
    daily = trends.daily_counts(sales.filter("invoice_date < '2010-02-01'"))
    counts = [(r.day.isoformat(), r.n) for r in daily.orderBy("day").collect()]
    assert counts[0] == ("2009-12-01", 2) and counts[-1] == ("2010-01-04", 1) and len(counts) == 35
    assert {r.year for r in daily.collect()} == {2009, 2010}
    report = trends.zero_day_report(daily, 3).collect()
    assert [(r.day.isoformat(), r.zero_days) for r in report] == [
        ("2009-12-02", 32),
        ("2009-12-03", 32),
        ("2009-12-04", 32),
    ]


def test_counts_per_customer_and_country(sales):
    rows = trends.customer_country_counts(sales, 2).collect()
    assert [tuple(r) for r in rows] == [(1, "France", 3), (1, "Spain", 2)]
    assert {r.year for r in distinct_values(sales, "year").collect()} == {2009, 2010}
