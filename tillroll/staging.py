"""Intermediate tables in the shared folder.

A plan whose result is read several times is written once as Parquet and read
back. That cuts the lineage in a way that survives the loss of executors, keeps
column pruning and filter pushdown for the readers, and gives the planner real
file sizes to choose join strategies by.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, or else one beside the session's own tables.

    Managed tables are written below the warehouse folder, so every executor reaches it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staged"


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tillroll/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path in a folder of this application, which ``release`` deletes."""
    return f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Deletes the shuffle files of a query at its end; Spark else does so when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage_compact(df: DataFrame, name: str = "stage") -> DataFrame:
    """As ``stage``, for many rows: compressed well, and the shuffles of the writing leave no files."""
    spark = df.sparkSession
    path, before = new_path(spark, name), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression="zstd")
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def stage_each(df: DataFrame, column: str, values: list[str], name: str = "stage") -> dict[str, DataFrame]:
    """Write ``df`` once, split by ``column``, and return a scan for each of its ``values``.

    Every part is a table of its own, so the planner knows its size.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(column).parquet(path)
    rest = df.drop(column)
    return {value: spark.read.schema(rest.schema).parquet(f"{path}/{column}={value}") for value in values}


def scratch_prefix(spark: SparkSession) -> str:
    return "tillroll_scratch_" + re.sub(r"\W", "_", spark.sparkContext.applicationId) + "_"


def scratch_database(spark: SparkSession) -> str:
    """Unused name of a database that lasts as long as the application's staged tables."""
    return scratch_prefix(spark) + uuid.uuid4().hex[:12]


def release(spark: SparkSession) -> None:
    """Delete everything this application has staged, and its scratch databases.

    Frames that still read staged tables fail afterwards, so call it when their results
    have been written.
    """
    for database in spark.catalog.listDatabases():
        if database.name.startswith(scratch_prefix(spark)):
            spark.sql(f"DROP DATABASE `{database.name}` CASCADE")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
