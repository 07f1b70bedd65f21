"""Histograms, box-plot statistics, density and rank correlation."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import one_row_each, signed_log
from tillroll.operators.ordering import QUARTILES, holds_quantile, quantile_picks, running_total, value_counts
from tillroll.operators.profiling import numeric_columns
from tillroll.operators.sampling import sample_rows
from tillroll.staging import stage, stage_each


def histogram(counts: DataFrame, bins: int) -> DataFrame:
    """Equal-width bins per column over (column, x, n), empty ones included.

    The last bin is closed; a column with a single value gets a range of width 1.
    """
    counts = stage(counts, "counts")
    ends = counts.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    point = F.col("lo") == F.col("hi")
    # One row per column of the frame, which bounds the broadcast.
    ranges = ends.select(
        "column",
        F.when(point, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(point, F.lit(1.0 / bins)).otherwise((F.col("hi") - F.col("lo")) / bins).alias("width"),
    )
    # The division can end one bin off the printed edges, which decide.
    near = F.least(F.floor((F.col("x") - F.col("lo")) / F.col("width")), F.lit(bins - 1))
    too_high = F.col("x") < F.col("lo") + near * F.col("width")
    too_low = (F.col("x") >= F.col("lo") + (near + 1) * F.col("width")) & (near < bins - 1)
    bin_of = near - too_high.cast("int") + too_low.cast("int")
    filled = (
        counts.join(F.broadcast(ranges), "column")
        .groupBy("column", bin_of.cast("int").alias("bin"))
        .agg(F.sum("n").alias("n"))
    )
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return frame.join(filled, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("right_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


DISTRIBUTION_COLUMNS = ["price", "quantity", "revenue"]


def signed_log_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    counts = value_counts(df, columns)
    return counts.select("column", signed_log(F.col("value")).alias("x"), "n")


def signed_log_histogram(df: DataFrame, columns: list[str] | None = None, bins: int = 50) -> DataFrame:
    return histogram(signed_log_counts(df, columns or DISTRIBUTION_COLUMNS), bins)


def length_histogram(df: DataFrame, column: str = "description", bins: int = 80) -> DataFrame:
    lengths = df.filter(F.col(column).isNotNull()).groupBy(F.length(column).cast("double").alias("x"))
    counts = lengths.agg(F.count(F.lit(1)).alias("n")).withColumn("column", F.lit(column))
    return histogram(counts, bins)


def density(
    df: DataFrame, columns: list[str] | None = None, n: int = 50_000, seed: int = 42, points: int = 200
) -> DataFrame:
    """Gaussian kernel density of a sample's signed logs at evenly spaced points.

    The bandwidth is Scott's: the sample deviation times count to the power -1/5. Each
    batch of sampled values is reduced to one sum per point before it leaves its task,
    so no (value, point) pair is ever a row.
    """
    columns = columns or DISTRIBUTION_COLUMNS
    sampled = sample_rows(df, n, seed, columns)
    counts = stage(signed_log_counts(sampled, columns), "density")
    weighted = F.col("n") * F.col("x")
    means = counts.groupBy("column").agg((F.sum(weighted) / F.sum("n")).alias("mean"))
    away = F.col("x") - F.col("mean")
    spread = (
        counts.join(F.broadcast(means), "column")
        .groupBy("column")
        .agg(
            F.sqrt(F.sum(F.col("n") * away * away) / F.nullif(F.sum("n") - 1, F.lit(0))).alias("sd"),
            F.sum("n").alias("count"),
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
        )
    )
    # One row per column of the frame, without those that have no spread and so no density.
    grid = spread.filter("sd > 0").select(
        "column",
        "count",
        "lo",
        ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step"),
        (F.col("sd") * F.pow(F.col("count"), F.lit(-0.2))).alias("width"),
    )

    def kernel_sums(batches):
        steps = np.arange(points)
        for batch in batches:
            for column, part in batch.groupby("column"):
                x, n, lo, step, width = (part[[c]].to_numpy() for c in ("x", "n", "lo", "step", "width"))
                kernels = n * np.exp(-0.5 * ((x - lo - steps * step) / width) ** 2)
                yield pd.DataFrame({"column": column, "point": steps, "height": kernels.sum(axis=0)})

    heights = (
        counts.join(F.broadcast(grid), "column")
        .mapInPandas(kernel_sums, "column string, point int, height double")
        .groupBy("column", "point")
        .agg(F.sum("height").alias("height"))
    )
    area = F.col("count") * F.col("width") * math.sqrt(2 * math.pi)
    return heights.join(F.broadcast(grid), "column").select(
        "column",
        "point",
        (F.col("lo") + F.col("point") * F.col("step")).alias("x"),
        (F.col("height") / area).alias("density"),
    )


def box_stats(df: DataFrame, columns: list[str] | None = None, key: str = "year") -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and outliers per column and key."""
    columns = columns or ["quantity", "price"]
    by = ["column", key]
    counts = stage(value_counts(df.filter(F.col(key).isNotNull()), columns, [key]), "counts")
    ranked = running_total(counts, by, ["value"], "n", holds_quantile(QUARTILES))
    boxes = ranked.groupBy(*by).agg(
        F.max("total").alias("count"),
        *[pick.alias(name) for name, pick in quantile_picks(QUARTILES).items()],
    )
    reach = (F.col("q75") - F.col("q25")) * 1.5
    value = F.col("value")
    inside = value.between(F.col("q25") - reach, F.col("q75") + reach)
    quartiles = ["count", "q25", "q50", "q75"]
    # Staged, the number of boxes is known, and they are broadcast if they are few.
    return (
        counts.join(stage(boxes, "boxes"), by)
        .groupBy(*by, *quartiles)
        .agg(
            F.min(F.when(inside, value)).alias("low"),
            F.max(F.when(inside, value)).alias("high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
        .select(
            *by,
            *quartiles,
            F.least("low", "q25").alias("whisker_low"),
            F.greatest("high", "q75").alias("whisker_high"),
            "outliers",
        )
    )


def present_masks(rows: DataFrame, columns: list[str]) -> list[int]:
    """Which sets of columns have values in the same row: bit i stands for ``columns[i]``."""
    return sorted(row[0] for row in rows.select(mask_of(columns).alias("mask")).distinct().collect())


def mask_of(columns: list[str]) -> Column:
    bits = [F.when(F.col(name).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(columns)]
    return reduce(add, bits)


def spearman(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rank correlation of every pair of numeric columns, with average ranks for ties.

    A pair goes by the rows in which both columns have a value, and ranks are those among
    these rows. They come from one table, which counts the values of each column by the
    other columns that are there too: for a pair, the counts with the other column are added
    up. Pairs that leave a column the same rows share its ranks, so without nulls every
    column is ranked once. A rank is kept as twice its distance from the mean rank, a whole
    number. The driver sees which columns occur together.
    """
    columns = columns or numeric_columns(df)
    rows = stage(df.select(*[F.col(name).cast("double").alias(name) for name in columns]), "numbers")
    masks = present_masks(rows, columns)

    def shared(a: int, b: int) -> tuple[int, ...]:
        """The masks of the rows that count for a pair."""
        return tuple(mask for mask in masks if mask >> a & 1 and mask >> b & 1)

    # Ranks of a column among the rows of some masks, under one number.
    ranked = {pair: number for number, pair in enumerate(sorted({(a, shared(a, b)) for a in range(len(columns)) for b in range(len(columns))}))}
    counts = stage(value_counts(rows.withColumn("mask", mask_of(columns)), columns, ["mask"]), "joint-counts")
    asked = [
        F.when((F.col("column") == columns[a]) & F.col("mask").isin(*among), F.lit(number))
        for (a, among), number in ranked.items()
        if among
    ]
    if not asked:
        empty = [[F.lit(a).alias("column"), *[F.lit(None).cast("double").alias(b) for b in columns]] for a in columns]
        return rows.sparkSession.range(1).select(one_row_each(*empty))
    each = counts.withColumn("ranks", F.explode(F.array_compact(F.array(*asked)))).groupBy("ranks", "value").agg(F.sum("n").alias("n"))
    running = running_total(each, ["ranks"], ["value"], "n")
    offset = F.lit(2) * F.col("upto") - F.col("n") - F.col("total")
    offsets = running.select("ranks", "value", offset.cast("double").alias("offset"))
    # The planner sees the size of each lookup and broadcasts short ones; for long ones
    # adaptive execution splits hot values. A missing value finds none.
    lookups = stage_each(offsets, "ranks", [str(number) for (_, among), number in ranked.items() if among], "ranks")
    for (a, among), number in ranked.items():
        if among:
            lookup = lookups[str(number)].select(F.col("value").alias(columns[a]), F.col("offset").alias(f"offset_{number}"))
            rows = rows.join(lookup, columns[a], "left")

    def product(a: int, b: int, x: int, y: int) -> Column:
        """Sum of products of ranks x and y over the rows of the pair (a, b)."""
        both = F.col(columns[a]).isNotNull() & F.col(columns[b]).isNotNull()
        return F.sum(F.when(both, F.col(f"offset_{x}") * F.col(f"offset_{y}")))

    pairs = [(a, b) for a in range(len(columns)) for b in range(a, len(columns)) if shared(a, b)]
    moments = []
    for a, b in pairs:
        x, y = ranked[a, shared(a, b)], ranked[b, shared(a, b)]
        moments += [product(a, b, *of).alias(f"{a}_{b}_{k}") for k, of in enumerate(((x, y), (x, x), (y, y)))]
    sums = rows.agg(*moments)

    matrix = []
    for a in range(len(columns)):
        cells = [F.lit(columns[a]).alias("column")]
        for b in range(len(columns)):
            low, high = min(a, b), max(a, b)
            if (low, high) in pairs:
                scale = F.sqrt(F.col(f"{low}_{high}_1") * F.col(f"{low}_{high}_2"))
                cell = F.col(f"{low}_{high}_0") / F.nullif(scale, F.lit(0.0))
            else:
                cell = F.lit(None).cast("double")
            cells.append(cell.alias(columns[b]))
        matrix.append(cells)
    return sums.select(one_row_each(*matrix))
