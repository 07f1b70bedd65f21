"""Comparison of two tables with the same key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import one_row_each
from tillroll.operators.ordering import running_total
from tillroll.staging import stage, stage_compact

# Tolerances of a floating-point comparison.
RELATIVE_TOLERANCE = 1e-5
ABSOLUTE_TOLERANCE = 1e-8

# A key in more rows than both of these, the second as one of so many of all, is not left to one task.
HOT_ROWS = 100_000
HOT_SHARE = 1_000
#: Values of the hash by which rows are counted to find such keys.
BUCKETS = 4_096
# From so many rows on they are dealt out in several passes, of which each deletes its shuffle files.
PASS_ROWS = 5_000_000
PASSES = 3


def close(a: Column, b: Column) -> Column:
    """Equal within the larger of both tolerances, relative to the larger number; nulls match nulls."""
    a, b = a.cast("double"), b.cast("double")
    reach = F.greatest(F.greatest(F.abs(a), F.abs(b)) * RELATIVE_TOLERANCE, F.lit(ABSOLUTE_TOLERANCE))
    return a.eqNullSafe(b) | F.coalesce(F.abs(a - b) <= reach, F.lit(False))


def bucket() -> Column:
    """A few values of a hash of the key ``k``."""
    return F.pmod(F.xxhash64("k"), F.lit(BUCKETS))


def hot_keys(keys: DataFrame, counts: dict[int, int]) -> DataFrame | None:
    """Staged values of ``k`` in more than ``HOT_ROWS`` rows and more than one of ``HOT_SHARE`` of all, if any.

    ``counts`` are the rows by ``bucket``; only keys in one with that many rows are counted themselves.
    """
    least = max(HOT_ROWS, sum(counts.values()) // HOT_SHARE)
    buckets = [number for number, n in counts.items() if n > least]
    if not buckets:
        return None
    counted = keys.filter(bucket().isin(buckets)).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    hot = stage(counted.filter(F.col("n") > least).select("k"), "hot")
    return None if hot.isEmpty() else hot


def met_by_key(rows: DataFrame) -> DataFrame:
    """Add ``place``, that of a row in its key and side, and ``other``, the right row at the place of a left one.

    Rows are dealt out by key once, and the rows of a key are in one task.
    """
    dealt = rows.repartition("k").withColumn("right", F.col("l").isNull())
    place = F.row_number().over(Window.partitionBy("k", "right").orderBy("l", "r"))
    along = Window.partitionBy("k").orderBy("place", "right")
    placed = dealt.withColumn("place", place.cast("bigint"))
    meets = F.lead("place").over(along) == F.col("place")
    return placed.withColumn("other", F.when(meets, F.lead("r").over(along))).select("l", "r", "place", "other")


def placed_over_slices(side: DataFrame, row: str) -> DataFrame:
    """Add ``place`` to rows of few keys. Equal rows are counted first, and places run over slices of rows."""
    counted = side.groupBy(F.struct("k").alias("key"), row).agg(F.count(F.lit(1)).alias("copies"))
    upto = running_total(counted, ["key"], [row], "copies")
    places = F.sequence(F.col("upto") - F.col("copies") + 1, F.col("upto"))
    return upto.select("key", row, F.explode(places).alias("place"))


def met_over_slices(rows: DataFrame) -> DataFrame:
    """As ``met_by_key``, but a key may hold any share of the rows; pairs are rows themselves."""
    left = placed_over_slices(rows.filter(F.col("l").isNotNull()).select("k", "l"), "l")
    right = placed_over_slices(rows.filter(F.col("r").isNotNull()).select("k", "r"), "r")
    paired = left.join(right, ["key", "place"], "full_outer")
    return paired.select("l", "r", "place", F.when(F.col("l").isNotNull(), F.col("r")).alias("other"))


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per column: rows on both sides, rows that differ, and rows on one side only.

    Fractions are compared within a tolerance, anything else exactly. Both tables are
    multisets: the rows of a repeated key meet in the order of their common columns, and
    those that one side has more of are on one side only; ``left_repeated`` and
    ``right_repeated`` count the rows after the first of their key. A missing key is a key.
    A column that one table lacks has a row of its own, with ``side`` and nothing compared.

    Rows of both tables are dealt out by key in one shuffle, in up to ``PASSES`` passes; the few
    keys that hold much of the rows go over slices of the order. The tables are read to count
    keys and once per pass, so they are better staged.
    """
    columns = [name for name in left.columns if name != key and name in right.columns]
    fractional = {
        field.name
        for field in left.schema.fields
        if isinstance(field.dataType, (T.FractionalType, T.DecimalType))
    }
    sides = [
        df.select(F.col(f"`{key}`").alias("k"), F.struct(*[f"`{name}`" for name in columns] or [F.lit(True)]).alias(side))
        for df, side in ((left, "l"), (right, "r"))
    ]
    rows = sides[0].unionByName(sides[1], allowMissingColumns=True)
    counted = rows.groupBy(bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    counts = {row.bucket: row.n for row in counted.collect()}
    hot, slices = hot_keys(rows.select("k"), counts), []
    if hot is not None:
        hot = hot.withColumnRenamed("k", "_hot")
        same = F.col("k").eqNullSafe(F.col("_hot"))
        slices = [met_over_slices(rows.join(hot, same, "left_semi"))]
        rows = rows.join(hot, same, "left_anti")
    passes = min(PASSES, 1 + sum(counts.values()) // PASS_ROWS)
    met = [met_by_key(rows.filter(bucket() % passes == number)) for number in range(passes)] + slices
    is_left, is_right, both = (F.col(name).isNotNull() for name in ("l", "r", "other"))

    def differs(name: str) -> Column:
        a, b = F.col(f"l.`{name}`"), F.col(f"other.`{name}`")
        return both & ~(close(a, b) if name in fractional else a.eqNullSafe(b))

    found = {
        "compared": F.count_if(both),
        "left_only": F.count_if(is_left & ~both),
        "right_only": F.count_if(is_right) - F.count_if(both),
        "left_repeated": F.count_if(is_left & (F.col("place") > 1)),
        "right_repeated": F.count_if(is_right & (F.col("place") > 1)),
        **{f"differ_{name}": F.count_if(differs(name)) for name in columns},
    }
    # One row per pass.
    rows_found = [stage_compact(part.agg(*[count.alias(name) for name, count in found.items()]), "found") for part in met]
    one_row = reduce(DataFrame.unionByName, rows_found).agg(*[F.sum(f"`{name}`").alias(name) for name in found])
    nothing = F.lit(None).cast("bigint")

    def report(name: str, side: str, compared: Column, mismatched: Column) -> list[Column]:
        return [
            F.lit(name).alias("column"),
            F.lit(side).alias("side"),
            compared.alias("compared"),
            mismatched.alias("mismatched"),
            (mismatched * 100.0 / F.nullif(compared, F.lit(0))).alias("mismatch_percent"),
            *[F.col(count) for count in ("left_only", "right_only", "left_repeated", "right_repeated")],
        ]

    rows = [report(name, "both", F.col("compared"), F.col(f"differ_{name}")) for name in columns]
    for side, df, others in (("left", left, right), ("right", right, left)):
        rows += [report(name, side, F.lit(0).cast("bigint"), nothing) for name in df.columns if name not in others.columns]
    return one_row.select(one_row_each(*rows))
