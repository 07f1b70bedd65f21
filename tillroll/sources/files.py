"""Delimited and Parquet files: raw landing, processed and feature tiers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.names import clean_column_names
from tillroll.sources.schemas import RAW_TRANSACTIONS, TRANSACTIONS
from tillroll.staging import new_path, stage


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    check_header: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Typed read of a file with a header, doubled quotes and empty fields as null.

    A malformed row fails the jobs that read all columns; others check the columns they
    read (``typed_tier`` checks all). ``check_header=False`` goes by position only.
    Files with line breaks inside quotes need ``multi_line``, which reads each file
    as one split, so it is off by default.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("enforceSchema", not check_header)
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_raw_transactions(spark: SparkSession, path: str, **options: bool) -> DataFrame:
    """Raw invoice lines with clean column names, once every row has been found well formed."""
    tier = typed_tier(spark, path, new_path(spark, "raw-tier"), RAW_TRANSACTIONS, **options)
    return clean_column_names(tier)


def read_processed_transactions(spark: SparkSession, path: str, **options: bool) -> DataFrame:
    """Processed lines with their types, once every row has been found well formed."""
    return typed_tier(spark, path, new_path(spark, "processed-tier"), TRANSACTIONS, **options)


def write_csv(df: DataFrame, path: str, first: str | None = None, compression: str = "none") -> None:
    """Write with a header, texts unchanged and no row index; parent folders are made as needed.

    ``first`` names the key column to put in front. With ``compression="gzip"`` files take
    about a quarter of the disk; each is then read by one task, as it was written by one.
    """
    if first:
        df = df.select(first, *[name for name in df.columns if name != first])
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
        .option("compression", compression)
        .csv(path)
    )


def folder(spark: SparkSession, path: str):
    """A path and the store it is in."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    at, store = folder(spark, path)
    store.delete(at, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    at, store = folder(spark, path)
    there, _ = folder(spark, target)
    store.mkdirs(there.getParent())
    if not store.rename(at, there):
        raise OSError(f"{path} could not be moved to {target}")


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether a folder has a visible file: not only hidden ones or those of a broken write."""
    at, store = folder(spark, path)
    return store.exists(at) and any(
        not status.getPath().getName().startswith(("_", ".")) for status in store.listStatus(at)
    )


def land(df: DataFrame, path: str, force: bool = False) -> None:
    """Write a Parquet tier unless it already holds data; ``force`` replaces it."""
    if force or not holds_data(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)


class MalformedRows(ValueError):
    """A file was not landed; ``rows`` are its bad rows, as ``bad_rows`` returns them."""

    def __init__(self, path: str, rows: DataFrame, listed: int = 5) -> None:
        first = rows.orderBy("file", "line").limit(listed).collect()
        shown = "; ".join(f"{row['file']}:{row['line']}: {row['problem']}: {row['record']}" for row in first)
        super().__init__(f"{rows.count()} malformed rows in {path}, nothing was landed. First: {shown}")
        self.rows = rows


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, record) of every line of the text files, lines from 1 within a file.

    Files are read in blocks by many tasks. A line's number is the lines in the blocks
    before its own, which are counted first, and its place within the block.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seat"),
        F.col("value").alias("record"),
    )
    blocks = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("lines"), F.min("seat").alias("first"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file", "block", "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    # One row per block of a file; staged, the planner knows how many they are.
    placed = lines.join(stage(offsets, "blocks"), ["file", "block"])
    return placed.select("file", (F.col("before") + F.col("seat") - F.col("first") + 1).alias("line"), "record")


def bad_rows(spark: SparkSession, path: str, schema: T.StructType, *, multi_line: bool = False) -> DataFrame:
    """(file, line, record, problem) of the rows that do not have the types of ``schema``.

    ``problem`` names the columns whose text is no value of their type, or says
    ``number of columns``. With ``multi_line`` a record is no line, and ``line`` is null.
    """
    corrupt = "_corrupt"
    names = schema.fieldNames()
    typed = T.StructType([*[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField(corrupt, T.StringType())])
    texts = T.StructType([T.StructField(name, T.StringType()) for name in names])
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    if multi_line:
        read = spark.read.schema(typed).options(header=True, multiLine=True, **options).csv(path)
        rows = read.select(
            F.col("_metadata.file_path").alias("file"),
            F.lit(None).cast("bigint").alias("line"),
            F.col(corrupt).alias("record"),
            F.struct(*[F.col(f"`{name}`") for name in typed.fieldNames()]).alias("typed"),
        )
    else:
        rows = numbered_lines(spark, path).filter((F.col("line") > 1) & (F.trim("record") != ""))
        rows = rows.withColumn("typed", F.from_csv("record", ddl(typed), options))
    rows = rows.filter(F.col(f"typed.{corrupt}").isNotNull())
    # Only bad rows are parsed again, as texts.
    read = rows.withColumn("texts", F.from_csv("record", ddl(texts), {"escape": '"'}))
    wrong = F.array_compact(
        F.array(*[F.when(F.col(f"typed.`{n}`").isNull() & F.col(f"texts.`{n}`").isNotNull(), F.lit(n)) for n in names])
    )
    problem = F.when(F.size(wrong) == 0, F.lit("number of columns")).otherwise(F.array_join(wrong, ","))
    return read.select("file", "line", "record", problem.alias("problem"))


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema.fields)


def typed_tier(spark: SparkSession, path: str, target: str, schema: T.StructType, force: bool = False, **options: bool) -> DataFrame:
    """Land the CSV files of ``path`` as Parquet at ``target``, all of them or nothing.

    A lazy read checks only the columns that a query asks for; here every column of every
    row is parsed, once. Rows go to a folder beside the target, which takes its place when
    all are written. If a row is malformed the target stays as it was, and the error lists
    the bad rows with file and line. A target that holds data is kept unless ``force``.
    """
    if force or not holds_data(spark, target):
        rows = read_csv(spark, path, schema, **options)
        waiting = f"{target.rstrip('/')}.landing-{uuid.uuid4().hex}"
        try:
            rows.write.parquet(waiting)
        except Exception as error:
            remove(spark, waiting)
            if "MALFORMED_RECORD" not in str(error):
                raise
            found = stage(bad_rows(spark, path, schema, multi_line=options.get("multi_line", False)), "bad-rows")
            raise MalformedRows(path, found) from None
        remove(spark, target)
        rename(spark, waiting, target)
    return spark.read.schema(schema).parquet(target)
