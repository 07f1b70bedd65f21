"""One feature row per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.customers import (
    add_average_order_value,
    add_recency,
    add_return_ratio,
    customer_core,
)
from tillroll.operators.scoring import add_scores, add_segments
from tillroll.plans.cleaning import product_lines
from tillroll.sources.schemas import FEATURE_COLUMNS
from tillroll.staging import stage


def features_from_core(core: DataFrame, rule: str = "ntile", edges: tuple[int, dict] | None = None) -> DataFrame:
    """Features of a staged customer core; ``rule`` picks how scores are cut, at ``edges`` if they are known."""
    return (
        add_recency(core)
        .transform(add_scores, rule=rule, edges=edges)
        .transform(add_segments)
        .transform(add_return_ratio)
        .transform(add_average_order_value)
        .select(*FEATURE_COLUMNS)
    )


def customer_features(transactions: DataFrame, rule: str = "ntile") -> DataFrame:
    """Features of an already cleaned transaction table.

    All measures of a customer come from one scan and one grouping. The result, one
    narrow row per customer, is staged; scoring reads only that.
    """
    return features_from_core(stage(customer_core(transactions), "customers"), rule)


def core_from_raw(raw: DataFrame) -> DataFrame:
    """Staged customer core straight from raw lines.

    A customer's balance is the revenue of the core, so customers below 0 are dropped
    after the grouping and the anti join of the cleaning step is not needed.
    """
    core = customer_core(product_lines(raw))
    return stage(core.filter(F.coalesce(F.col("monetary") >= 0, F.lit(True))), "customers")


def customer_features_from_raw(raw: DataFrame, rule: str = "ntile") -> DataFrame:
    return features_from_core(core_from_raw(raw), rule)


def customer_features_joined(transactions: DataFrame) -> DataFrame:
    """The same features with the ratio and order value joined on, not carried along.

    Kept as the plain statement of what the fused plan has to return.
    """
    core = stage(customer_core(transactions), "customers")
    scored = add_segments(add_scores(add_recency(core)))
    ratios = add_return_ratio(core).select("customer_id", "return_ratio")
    values = add_average_order_value(core).select("customer_id", "avg_order_value")
    return (
        scored.join(ratios, "customer_id", "left")
        .join(values, "customer_id", "left")
        .select(*FEATURE_COLUMNS)
    )
