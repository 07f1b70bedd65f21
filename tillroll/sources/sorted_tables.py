"""Tables in the total order of a key: disjoint key ranges per file, and an index of the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.staging import new_path

#: Folder of the index, which readers of the table skip.
INDEX = "_files"


def write_sorted(df: DataFrame, path: str, key: str, files: int | None = None) -> None:
    """Write ``df`` at ``path`` so that its files, in order of their first key, hold ascending keys.

    A range shuffle deals out the keys and every task sorts its own; rows without a key come
    first. ``files`` is the number of ranges, the session's shuffle partitions by default. The
    index has a row per file: its number, name, rows, and first and last key. Key ranges meet
    in one key at most where a key has more rows than a file.
    """
    spark = df.sparkSession
    ranges = df.repartitionByRange(files, key) if files else df.repartitionByRange(key)
    ranges.sortWithinPartitions(key).write.mode("overwrite").parquet(path)
    found = spark.read.schema(df.schema).parquet(path).groupBy(F.col("_metadata.file_name").alias("name")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(key).isNull()).alias("without_key"),
        F.min(key).alias("first"),
        F.max(key).alias("last"),
    )
    found.coalesce(1).write.parquet(f"{path}/{INDEX}")


def file_index(spark: SparkSession, path: str) -> DataFrame:
    """(name, rows, without_key, first, last) of every file of a sorted table."""
    return spark.read.parquet(f"{path}/{INDEX}")


def read_in_order(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The rows with ``position``, their place in the total order from 1, without a sort.

    A place is the rows of the files before and the place in the file.
    """
    index = file_index(spark, path).orderBy(F.col("first").asc_nulls_first(), F.col("last").asc_nulls_first(), "name").collect()
    before, places = 0, []
    for row in index:
        places.append((row["name"], before))
        before += row["rows"]
    # One row per file.
    starts = spark.createDataFrame(places, "_name string, _before long")
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.row_index").alias("_row"))
    placed = rows.join(F.broadcast(starts), "_name")
    return placed.withColumn("position", F.col("_before") + F.col("_row") + 1).drop("_name", "_before", "_row")


def lookup(spark: SparkSession, path: str, key: str, value) -> DataFrame:
    """The rows with one key, read from the files whose range holds it only."""
    holds = (F.col("first") <= F.lit(value)) & (F.lit(value) <= F.col("last"))
    if value is None:
        holds = F.col("without_key") > 0
    schema = spark.read.parquet(path).schema
    names = [f"{path}/{row['name']}" for row in file_index(spark, path).filter(holds).select("name").collect()]
    rows = spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)
    return rows.filter(F.col(key).eqNullSafe(F.lit(value)))


def sorted_copy(df: DataFrame, key: str, files: int | None = None) -> DataFrame:
    """A staged copy of ``df`` in the order of ``key``, with ``position``."""
    path = new_path(df.sparkSession, "sorted")
    write_sorted(df, path, key, files)
    return read_in_order(df.sparkSession, path, key)
