"""Samples of an exact size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.staging import stage

#: Hexadecimal digits of a draw per level of the histogram: 65,536 counts.
LEVEL = 4
#: Equal rows that one task draws for at once.
BLOCK = 1 << 14


def row_text(names: list[str]) -> Column:
    """Text of a row that no other row has, nulls and empty texts told apart."""
    texts = [F.col(f"`{name}`").cast("string") for name in names]
    return F.concat_ws("|", *[F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")) for text in texts])


def copy_draws(groups: DataFrame, seed: int) -> DataFrame:
    """(row, draw) for every copy of every distinct row; a hot row's copies leave it in blocks."""
    blocks = groups.withColumn("block", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies", F.lit(BLOCK).cast("bigint"))))
    hot = F.col("copies") > BLOCK
    blocks = blocks.filter(~hot).unionByName(blocks.filter(hot).repartition("row", "block"))
    copy = F.explode(F.sequence("block", F.least(F.col("block") + BLOCK - 1, "copies")))
    copies = blocks.select("row", copy.alias("copy"))
    digest = F.lower(F.hex("row"))
    return copies.select("row", F.md5(F.concat_ws("|", F.lit(str(seed)), digest, "copy")).alias("draw"))


def lowest(draws: DataFrame, n: int) -> DataFrame:
    """The ``n`` lowest draws, ties by row, found by a histogram of two levels.

    Only the draws in the last bucket of the second level, about one in 2**32 of them, are
    sorted. The driver sees the counts of one level.
    """
    taken, prefix, sure = 0, "", F.lit(False)
    for level in range(2):
        lead = F.substring("draw", LEVEL * level + 1, LEVEL)
        inside = draws.filter(F.startswith("draw", F.lit(prefix))) if prefix else draws
        counts = inside.groupBy(lead.alias("lead")).agg(F.count(F.lit(1)).alias("n")).orderBy("lead").toPandas()
        upto = taken + np.cumsum(counts["n"].to_numpy(np.int64))
        last = int(np.searchsorted(upto, n))
        if last == len(upto):
            return draws.filter(sure | F.startswith("draw", F.lit(prefix))) if prefix else draws
        prefix += counts["lead"][last]
        taken = int(upto[last] - counts["n"][last])
        sure = F.substring("draw", 1, len(prefix)) < prefix
    edge = draws.filter(F.startswith("draw", F.lit(prefix))).orderBy("draw", "row").limit(n - taken)
    return draws.filter(sure).unionByName(edge)


def sample_rows(df: DataFrame, n: int, seed: int = 42, columns: list[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows without replacement (all, if there are fewer).

    Every copy of a row draws a number from a hash of the row, the number of the copy and
    the seed, and the ``n`` lowest are taken: the sample does not depend on how the data
    is laid out, and of equal rows any number may be in it. Rows are counted and drawn for
    by digest, and only the rows of the sample are moved. ``df`` is computed once and staged,
    as it is read twice: its files are less than its shuffles. With ``columns`` only these are
    staged, beside the digest of the whole row, and returned: the sample is the same.
    """
    digest = F.unhex(F.md5(row_text(df.columns))).alias("_row")
    if columns is None:
        columns = df.columns
        digested = stage(df, "sampled").withColumn("_row", digest)
    else:
        digested = stage(df.select(*[F.col(f"`{name}`") for name in columns], digest), "sampled")
    groups = stage(digested.groupBy(F.col("_row").alias("row")).agg(F.count(F.lit(1)).alias("copies")), "copies")
    chosen = lowest(copy_draws(groups, seed), n).groupBy(F.col("row").alias("_row")).agg(F.count(F.lit(1)).alias("_times"))
    # Staged, the planner knows the size of the sample.
    met = digested.join(stage(chosen, "chosen"), "_row")
    # Equal rows are one, as often as it was drawn.
    once = met.groupBy("_row", "_times").agg(*[F.first(F.col(f"`{name}`")).alias(f"_{i}") for i, name in enumerate(columns)])
    again = once.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_times")))
    return again.select(*[F.col(f"_{i}").alias(name) for i, name in enumerate(columns)])
