"""Connected components by contraction, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.staging import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); a component is its smallest node.

    In each round every name is replaced by the smallest name among itself and its
    neighbours, and the edges between equal names disappear. Edges between the new names
    connect what was connected before, and the smallest node of a component never changes
    its name, so it is the last name left. A hub with most of the edges is no hot spot:
    minima are combined before the shuffle, and the join side that repeats a name can be
    split by adaptive execution. Without edges the result is empty.
    """
    edges = stage(edges.filter("a <> b").distinct(), "edges")
    names = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        least = stage(
            both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("name"), F.least("a", "least").alias("least")),
            "least",
        )
        if least.isEmpty():
            return names
        renamed = names.join(least, F.col("component") == F.col("name"), "left")
        names = stage(renamed.select("node", F.coalesce("least", "component").alias("component")), "names")
        left = least.toDF("a", "new_a")
        right = least.toDF("b", "new_b")
        edges = stage(
            edges.join(left, "a").join(right, "b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).filter("a <> b").distinct(),
            "edges",
        )
