"""Customer clusters."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import one_row_each, signed_log

CLUSTER_INPUTS = ["recency", "frequency", "monetary", "return_ratio", "avg_order_value"]


def cluster_inputs(features: DataFrame) -> DataFrame:
    """Long-tailed measures on a log scale."""
    return features.select(
        "customer_id", *[signed_log(F.col(name)).alias(name) for name in CLUSTER_INPUTS]
    )


def fit_clusters(
    features: DataFrame, k: int = 4, seed: int = 42, partitions: int = 8, max_iterations: int = 20, tolerance: float = 1e-4
) -> PipelineModel:
    """Fit scaling and K-Means on ``partitions`` sorted parts of the customers.

    The parts and their order depend on the customers only, and so does the random
    start: the files that ``features`` is read from make no difference. Fitting ends when no
    centre moves further than ``tolerance``, or after ``max_iterations``.
    """
    stages = [
        VectorAssembler(inputCols=CLUSTER_INPUTS, outputCol="raw_vector"),
        StandardScaler(inputCol="raw_vector", outputCol="features", withMean=True, withStd=True),
        KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed, maxIter=max_iterations, tol=tolerance),
    ]
    in_order = features.repartition(partitions, "customer_id").sortWithinPartitions("customer_id")
    return Pipeline(stages=stages).fit(cluster_inputs(in_order))


def assign_clusters(model: PipelineModel, features: DataFrame) -> DataFrame:
    return model.transform(cluster_inputs(features)).select("customer_id", "cluster")


def check_fixed_point(model: PipelineModel, features: DataFrame, reach: float = 1e-6) -> DataFrame:
    """Whether the clusters are a fixed point: (condition, checked, violations).

    Every customer belongs to the nearest centre, and every coordinate of a centre is the
    mean of its members, within ``reach``. One pass over the customers.
    """
    centres = model.stages[-1].clusterCenters()
    placed = model.transform(cluster_inputs(features)).withColumn("x", vector_to_array("features"))
    axes = range(len(CLUSTER_INPUTS))
    distances = [
        sum(((F.col("x")[i] - F.lit(float(centre[i]))) ** 2 for i in axes), F.lit(0.0)) for centre in centres
    ]
    own = F.element_at(F.array(*distances), F.col("cluster") + 1)
    farther = own > F.array_min(F.array(*distances)) + reach
    clusters = placed.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(farther).alias("farther"), *[F.avg(F.col("x")[i]).alias(f"x{i}") for i in axes]
    )
    centre = [
        F.element_at(F.array(*[F.lit(float(each[i])) for each in centres]), F.col("cluster") + 1) for i in axes
    ]
    off = sum(((F.abs(F.col(f"x{i}") - centre[i]) > reach).cast("bigint") for i in axes), F.lit(0).cast("bigint"))
    sums = clusters.agg(
        F.sum("members").alias("members"),
        F.sum("farther").alias("farther"),
        (F.count(F.lit(1)) * len(axes)).alias("coordinates"),
        F.sum(off).alias("off"),
    )
    return sums.select(
        one_row_each(
            [F.lit("nearest centre").alias("condition"), F.col("members").alias("checked"), F.col("farther").alias("violations")],
            [F.lit("mean of members").alias("condition"), F.col("coordinates").alias("checked"), F.col("off").alias("violations")],
        )
    )


def silhouette(model: PipelineModel, features: DataFrame) -> float:
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    return evaluator.evaluate(model.transform(cluster_inputs(features)))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
