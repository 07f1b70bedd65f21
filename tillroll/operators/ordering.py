"""Exact ranks and quantiles over a global order, without a one-task sort.

Ranks, quantile scores, percentiles and rank correlations all need positions in an
order over the whole table. A window without a partition would send every row to
one task. Here rows are cut into contiguous slices by a range shuffle, each slice is
summed, and the few slice sums give the offset at which each slice starts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import METRIC_TYPE
from tillroll.staging import stage

def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    weight: str | None = None,
    holds: Callable[[Column, Column, Column], Column] | None = None,
) -> DataFrame:
    """Add ``upto``, the sum of ``weight`` up to and with this row, and ``total``.

    Sums run within each group of ``by`` (few of them: column names, years) in the order
    of ``order``, which must be unique within it; a hot value is either counted into
    one row first or told apart by a key, so the range shuffle can always split it.
    ``holds`` tells, from the sum before a slice, the sum with it and the total, whether
    any of its rows is asked for; without it all are. Other slices are only summed.
    """
    amount = F.col(weight) if weight else F.lit(1).cast("bigint")
    start_to_here = (Window.unboundedPreceding, Window.currentRow)
    sliced = stage(
        df.repartitionByRange(*by, *order).withColumn("slice", F.spark_partition_id()), "sliced"
    )
    # A slice is a contiguous range, so there are fewer (by, slice) pairs than slices
    # plus groups. Staged, their size is known, and they are broadcast if it is small.
    sums = sliced.groupBy(*by, "slice").agg(F.sum(amount).alias("slice_sum"))
    groups = Window.partitionBy(*by)
    offsets = sums.select(
        *by,
        "slice",
        "slice_sum",
        (
            F.sum("slice_sum").over(groups.orderBy("slice").rowsBetween(*start_to_here)) - F.col("slice_sum")
        ).alias("before"),
        F.sum("slice_sum").over(groups).alias("total"),
    )
    if holds:
        offsets = offsets.filter(holds(F.col("before"), F.col("before") + F.col("slice_sum"), F.col("total")))
    within = Window.partitionBy(*by, "slice").orderBy(*order).rowsBetween(*start_to_here)
    return (
        sliced.join(stage(offsets.drop("slice_sum"), "offsets"), [*by, "slice"])
        .withColumn("upto", F.col("before") + F.sum(amount).over(within))
        .drop("slice", "before")
    )


def previous_rows(df: DataFrame, by: str, order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Add ``previous_<value>`` for each of ``values``: that of the row before within ``by``, or null.

    Rows are cut into contiguous slices of the order by (``by``, ``order``), which must be
    unique, so one group may hold any share of the rows. Within a slice a window looks
    back; the first row of a slice looks at a halo of one row, the last one of the slices
    before it. Halos are one row per slice. Rows without ``by`` are a group.
    """
    sliced = stage(df.repartitionByRange(by, *order).withColumn("slice", F.spark_partition_id()), "sliced")
    ends = sliced.groupBy("slice").agg(F.max(F.struct(F.col(by).alias("by"), *dict.fromkeys([*order, *values]))).alias("end"))
    slices = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    # As many rows as slices; the largest row of all slices before is the last of the nearest.
    halos = stage(ends.select("slice", F.max("end").over(slices).alias("halo")), "halos")
    within = Window.partitionBy(by, "slice").orderBy(*order)
    placed = sliced.join(halos, "slice").withColumn("first", F.row_number().over(within) == 1)
    same = F.col("first") & F.col(by).eqNullSafe(F.col("halo.by")) & F.col("halo").isNotNull()
    looked = {
        f"previous_{name}": F.when(same, F.col(f"halo.{name}")).otherwise(F.lag(name).over(within)) for name in values
    }
    return placed.withColumns(looked).select(*df.columns, *looked)


def long_form(df: DataFrame, columns: Sequence[str], keys: Sequence[str], kind: str) -> DataFrame:
    """One row per column and row, as (keys, column, value) with values of one type."""
    typed = df.select(*keys, *[F.col(name).cast(kind).alias(name) for name in columns])
    return typed.unpivot(list(keys), list(columns), "column", "value")


def value_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """How often each non-null value occurs per column and key: (keys, column, value, n).

    Values are doubles, the type of all statistics. All columns are counted in one
    pass, and a frequent value is a single row from here on.
    """
    values = long_form(df, columns, keys, "double").filter(F.col("value").isNotNull())
    return values.groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("n"))


def rank_rows(df: DataFrame, key: str, columns: Sequence[str], ranks: Sequence[int] | None = None) -> DataFrame:
    """Rank of every row by each column, nulls last, ties broken by ``key``: (key, column, value, rank).

    Values stay exact decimals, so that ranks follow the amounts to the last digit. With
    ``ranks``, only the rows of these ranks are found and returned.
    """
    values = long_form(df, columns, [key], METRIC_TYPE).withColumn("missing", F.col("value").isNull())
    asked = F.array(*[F.lit(rank).cast("bigint") for rank in ranks or []])
    holds = None
    if ranks is not None:
        holds = lambda before, upto, _: F.exists(asked, lambda rank: (before < rank) & (rank <= upto))
    ranked = running_total(values, ["column"], ["missing", "value", key], holds=holds)
    ranked = ranked.select(key, "column", "value", F.col("upto").alias("rank"))
    return ranked if ranks is None else ranked.filter(F.array_contains(asked, F.col("rank")))


QUARTILES = {"q25": (1, 4), "q50": (1, 2), "q75": (3, 4)}


def holds_quantile(quantiles: dict[str, tuple[int, int]]) -> Callable[[Column, Column, Column], Column]:
    """Whether a slice holds one of the two values around a quantile."""

    def holds(before: Column, upto: Column, total: Column) -> Column:
        needed = F.lit(False)
        for top, bottom in quantiles.values():
            low = F.floor(F.lit(top) * (total - 1) / bottom)
            needed = needed | ((before <= low + 1) & (low < upto))
        return needed

    return holds


def quantile_picks(quantiles: dict[str, tuple[int, int]]) -> dict[str, Column]:
    """Aggregates that read linear quantiles off counted, running-total rows.

    A quantile a/b of ``total`` values lies a*(total-1)/b steps after the first: it is
    taken between the two values at the whole steps around it.
    """

    def value_at(step):
        holds = (F.col("upto") - F.col("n") <= step) & (step < F.col("upto"))
        return F.max(F.when(holds, F.col("value")))

    picks = {}
    for name, (top, bottom) in quantiles.items():
        steps = F.lit(top) * (F.col("total") - 1)
        low = F.expr(f"({top} * (total - 1)) div {bottom}")
        part = F.max(steps % bottom).cast("double") / F.lit(float(bottom))
        high = F.when(steps % bottom == 0, low).otherwise(low + 1)
        picks[name] = value_at(low) + (value_at(high) - value_at(low)) * part
    return picks


def asked_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column name, whether ``df`` has a value there or not."""
    return df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, columns)).cast("array<string>")).alias("column"))


def describe_counts(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of each column.

    ``counts`` is a result of ``value_counts`` without keys. A column without a value has
    a count of 0 and nothing else.
    """
    counts = stage(counts, "counts")
    mean = (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean")
    # One row per column of the described frame, which bounds the broadcasts.
    means = F.broadcast(counts.groupBy("column").agg(mean))
    away = F.col("value") - F.col("mean")
    moments = counts.join(means, "column").groupBy("column").agg(
        F.sum("n").alias("count"),
        F.max("mean").alias("mean"),
        F.sqrt(F.sum(F.col("n") * away * away) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    picked = running_total(counts, ["column"], ["value"], "n", holds_quantile(QUARTILES))
    quartiles = picked.groupBy("column").agg(*[pick.alias(name) for name, pick in quantile_picks(QUARTILES).items()])
    described = moments.join(F.broadcast(quartiles), "column")
    return asked_columns(counts, columns).join(F.broadcast(described), "column", "left").select(
        "column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", *QUARTILES, "max"
    )
