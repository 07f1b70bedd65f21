"""Sketches of distinct values and quantiles per month, merged for any span of months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import one_row_each
from tillroll.operators.profiling import numeric_columns

#: Registers of a distinct sketch, as a power of two, and size of a quantile sketch.
LOG_REGISTERS = 14
QUANTILE_SIZE = 1024


def distinct_error(log_registers: int = LOG_REGISTERS) -> float:
    """Relative standard error of a merged distinct sketch."""
    return 1.04 / (1 << log_registers) ** 0.5


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """Share of the rows by which the rank of a quantile may be off, in 99 of 100 cases."""
    return 2.296 / size**0.9021


def monthly_sketches(df: DataFrame, columns: list[str], log_registers: int = LOG_REGISTERS, size: int = QUANTILE_SIZE) -> DataFrame:
    """(year, month, column, present, distinct, quantiles): a few KB per month and column.

    ``df`` has ``year`` and ``month``; nulls are not counted. Text columns have no
    quantiles. Sketches are built in every task and merged, so a month may hold any share
    of the rows; stored, they answer for any span of months without the rows.
    """
    numbers = set(numeric_columns(df))
    measures = []
    for i, name in enumerate(columns):
        measures += [
            F.count(name).alias(f"present_{i}"),
            F.hll_sketch_agg(F.col(name).cast("string"), log_registers).alias(f"distinct_{i}"),
        ]
        if name in numbers:
            measures.append(F.kll_sketch_agg_double(F.col(name).cast("double"), size).alias(f"quantiles_{i}"))
    wide = df.groupBy("year", "month").agg(*measures)
    rows = [
        [
            F.lit(name).alias("column"),
            F.col(f"present_{i}").alias("present"),
            F.col(f"distinct_{i}").alias("distinct"),
            (F.col(f"quantiles_{i}") if name in numbers else F.lit(None).cast("binary")).alias("quantiles"),
        ]
        for i, name in enumerate(columns)
    ]
    return wide.select("year", "month", one_row_each(*rows))


def sketched_summary(sketches: DataFrame, first: tuple[int, int], last: tuple[int, int]) -> DataFrame:
    """(column, present, distinct_values, q25, q50, q75) over the months from ``first`` to ``last``.

    Distinct values are within a few ``distinct_error``, and the ranks of quantiles within
    ``rank_error`` of the exact ones.
    """
    month = F.col("year") * 12 + F.col("month")
    inside = sketches.filter(month.between(first[0] * 12 + first[1], last[0] * 12 + last[1]) & (F.col("present") > 0))
    merged = inside.groupBy("column").agg(
        F.sum("present").alias("present"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.max(F.col("quantiles").isNotNull()).alias("has_quantiles"),
    )
    return merged.select(
        "column",
        "present",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        *[
            F.when(F.col("has_quantiles"), F.kll_sketch_get_quantile_double("quantiles", F.lit(q))).alias(name)
            for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
        ],
    )


def check_sketches(df: DataFrame, summary: DataFrame, columns: list[str], sigmas: float = 4.0) -> DataFrame:
    """Per column of ``summary``: exact distinct values of ``df``, and whether the sketches keep their bounds.

    ``df`` holds the rows of the sketched months. The summary has one row per column.
    """
    numbers = [name for name in columns if name in set(numeric_columns(df))]
    values = df.select(*[F.col(name).cast("string").alias(name) for name in columns]).unpivot([], columns, "column", "value")
    exact = values.filter("value IS NOT NULL").groupBy("column").agg(F.count_distinct("value").alias("exact_distinct"))
    numeric = df.select(*[F.col(name).cast("double").alias(name) for name in numbers]).unpivot([], numbers, "column", "value")
    marks = F.broadcast(summary.select("column", "q25", "q50", "q75"))
    ranks = numeric.filter("value IS NOT NULL").join(marks, "column").groupBy("column").agg(
        *[
            measure
            for name in ("q25", "q50", "q75")
            for measure in (
                F.avg((F.col("value") < F.col(name)).cast("double")).alias(f"below_{name}"),
                F.avg((F.col("value") <= F.col(name)).cast("double")).alias(f"upto_{name}"),
            )
        ]
    )
    error = F.lit(rank_error())
    kept = F.lit(True)
    for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        kept = kept & (F.col(f"below_{name}") <= q + error) & (F.col(f"upto_{name}") >= q - error)
    close = F.abs(F.col("distinct_values") - F.col("exact_distinct")) <= F.greatest(
        F.lit(sigmas * distinct_error()) * F.col("exact_distinct"), F.lit(1.0)
    )
    return summary.join(F.broadcast(exact), "column").join(F.broadcast(ranks), "column", "left").select(
        "column", "present", "exact_distinct", close.alias("distinct_within"), F.coalesce(kept, F.lit(True)).alias("ranks_within")
    )
