"""Quantile scores and customer segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import METRIC_TYPE
from tillroll.operators.ordering import rank_rows

# Metric -> score column, and whether the smallest value gets the highest score.
SCORES = {
    "recency": ("recency_score", True),
    "frequency": ("frequency_score", False),
    "monetary": ("monetary_score", False),
}
BUCKETS = 5


def last_ranks(n: int, buckets: int, rule: str) -> list[int]:
    """Last rank of every bucket but the final one, for ``n`` ranked rows.

    ``ntile`` fills buckets evenly and gives the first ``n mod buckets`` one row more.
    ``rank_cut`` cuts the ranks 1..n at equal-probability, right-closed linear edges;
    it needs two rows to have distinct edges.
    """
    if rule == "ntile":
        size, extra = divmod(n, buckets)
        return [b * size + min(b, extra) for b in range(1, buckets)]
    if rule == "rank_cut":
        if n < 2:
            raise ValueError("a rank cut needs at least two rows")
        return [1 + b * (n - 1) // buckets for b in range(1, buckets)]
    raise ValueError(f"unknown rule: {rule}")


def bucket_edges(
    df: DataFrame, key: str = "customer_id", rules: Sequence[str] = ("ntile",), buckets: int = BUCKETS
) -> tuple[int, dict]:
    """Number of rows, and the (value, key) at the end of every bucket of all ``rules``, by (metric, rank)."""
    n = df.count()
    # Without rows every end is rank 0, which no row holds.
    ends = {end for rule in rules for end in last_ranks(n, buckets, rule) if end}
    edges = rank_rows(df, key, list(SCORES), sorted(ends)).collect()
    return n, {(edge["column"], edge["rank"]): (edge["value"], edge[key]) for edge in edges}


def add_scores(
    df: DataFrame, key: str = "customer_id", rule: str = "ntile", buckets: int = BUCKETS, edges: tuple[int, dict] | None = None
) -> DataFrame:
    """Add a 1..``buckets`` score per metric, ordered by (metric, key), null metrics last.

    ``df`` has one row per key and is read several times, so it should be staged. Only
    the row at the end of each bucket is looked up (at most ``buckets - 1`` per metric), or
    taken from ``edges``; a row's score is then the number of those it lies beyond, which
    is decided row by row and moves no data. Both rules rank null metrics last.
    """
    n, edge_at = edges or bucket_edges(df, key, [rule], buckets)
    ends = [end for end in last_ranks(n, buckets, rule) if end]

    def beyond(metric: str, end: int) -> Column:
        value, owner = edge_at[metric, end]
        here = F.col(metric).cast(METRIC_TYPE)
        after = F.col(key) > F.lit(owner)
        if value is None:
            return F.coalesce(here.isNull() & after, F.lit(False))
        edge = F.lit(value).cast(METRIC_TYPE)
        return here.isNull() | (here > edge) | ((here == edge) & after)

    scores = {}
    for metric, (name, smallest_is_best) in SCORES.items():
        bucket = sum((beyond(metric, end).cast("int") for end in ends), F.lit(1))
        scores[name] = F.lit(buckets + 1) - bucket if smallest_is_best else bucket
    return df.withColumns(scores)


# Segment of each range of (recency score, frequency score).
SEGMENTS = [
    ((1, 2), (1, 2), "hibernating"),
    ((1, 2), (3, 4), "at_risk"),
    ((1, 2), (5, 5), "cant_lose"),
    ((3, 3), (1, 2), "about_to_sleep"),
    ((3, 3), (3, 3), "need_attention"),
    ((3, 4), (4, 5), "loyal_customers"),
    ((4, 4), (1, 1), "promising"),
    ((5, 5), (1, 1), "new_customers"),
    ((4, 5), (2, 3), "potential_loyalists"),
    ((5, 5), (4, 5), "champions"),
]


def segment(recency_score: str, frequency_score: str) -> Column:
    """Name of the segment for two score columns; null for scores outside 1..5."""
    rules = [
        f"WHEN {recency_score} BETWEEN {r[0]} AND {r[1]} AND {frequency_score} BETWEEN {f[0]} AND {f[1]} "
        f"THEN '{name}'"
        for r, f, name in SEGMENTS
    ]
    return F.expr(f"CASE {' '.join(rules)} END")


def add_segments(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "r_f_score": F.expr("concat(recency_score, frequency_score)"),
            "segment": segment("recency_score", "frequency_score"),
        }
    )


def segment_profile(features: DataFrame) -> DataFrame:
    """Customers and mean measures per segment."""
    return features.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("recency").alias("mean_recency"),
        F.avg("frequency").alias("mean_frequency"),
        (F.sum("monetary").cast("double") / F.count("monetary")).alias("mean_monetary"),
        F.avg("return_ratio").alias("mean_return_ratio"),
        F.avg("avg_order_value").alias("mean_avg_order_value"),
    )
