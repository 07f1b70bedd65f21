"""Column expressions with the null, time and text rules of the retail data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for every money or count metric, so that different columns can be
# ranked, counted and compared in one long frame without losing digits.
METRIC_TYPE = "decimal(28,6)"


def is_true(condition: Column) -> Column:
    """Three-valued condition as a plain boolean, so that ``~`` keeps null rows."""
    return F.coalesce(condition, F.lit(False))


# Every whitespace character of Unicode; the highest is the ideographic space U+3000.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip_whitespace(text: Column) -> Column:
    """Remove leading and trailing whitespace of any Unicode kind."""
    return F.trim(text, F.lit(WHITESPACE))


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole 24-hour periods between two time-zone free timestamps."""
    return F.extract(F.lit("DAY"), later - earlier)


def elapsed_seconds(later: Column, earlier: Column) -> Column:
    """Seconds between two time-zone free timestamps, to the microsecond."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)")


def signed_log(value: Column) -> Column:
    """Logarithm of the magnitude that keeps the sign and maps 0 to 0."""
    number = value.cast("double")
    return F.signum(number) * F.log1p(F.abs(number))


def year_month(year: Column, month: Column) -> Column:
    return F.concat_ws("-", year.cast("string"), F.lpad(month.cast("string"), 2, "0"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double precision; null when the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def one_row_each(*rows: list[Column]) -> Column:
    """Turn the columns of a one-row aggregate into several rows (use in ``select``)."""
    return F.inline(F.array(*[F.struct(*row) for row in rows]))
