"""Databases and typed tables of the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.files import read_csv
from tillroll.sources.names import identifier
from tillroll.sources.schemas import TRANSACTIONS


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Drop the database with everything in it and create it empty."""
    name = identifier(name)
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    at = " LOCATION :at" if location else ""
    spark.sql(f"CREATE DATABASE {name}{at}", args={"at": location} if location else None)


def create_transactions_table(spark: SparkSession, database: str, table: str) -> str:
    """Create the typed transaction table if it is absent; returns its full name."""
    name = f"{identifier(database)}.{identifier(table)}"
    # Column names and types of the typed transaction table.
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {name} (
            invoice VARCHAR(50) NOT NULL,
            stock_code VARCHAR(50),
            description STRING,
            quantity INT,
            invoice_date TIMESTAMP_NTZ,
            price DECIMAL(10,2),
            customer_id INT,
            country VARCHAR(100),
            revenue DECIMAL(20,2),
            year INT,
            month INT
        ) USING parquet
        """
    )
    return name


def load_transactions(spark: SparkSession, path: str, database: str, table: str, **options: bool) -> str:
    """Append a CSV to the typed table by position.

    A malformed row, a missing invoice number, an over-long text or a number out of
    range fails the job, and then nothing of the file is added.
    """
    name = f"{identifier(database)}.{identifier(table)}"
    rows = read_csv(spark, path, TRANSACTIONS, check_header=False, **options)
    append_transactions(rows, name)
    return name


def append_transactions(rows: DataFrame, table: str) -> None:
    """Append rows to the typed table with its NOT NULL rule applied row by row.

    Parquet tables take nulls in NOT NULL columns silently, hence the check here.
    """
    present = F.coalesce("invoice", F.raise_error(F.lit("invoice must not be null")))
    columns = [
        F.col(field.name).cast(field.dataType).alias(field.name) for field in TRANSACTIONS.fields
    ]
    rows.withColumn("invoice", present).select(*columns).write.insertInto(table)


def replace_table(df: DataFrame, database: str, table: str) -> str:
    """Drop the table if it exists and create it from the result of ``df``."""
    name = f"{identifier(database)}.{identifier(table)}"
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return name


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{identifier(database)}.{identifier(table)}")


def table_shape(df: DataFrame) -> tuple[int, int]:
    """Number of rows and columns."""
    return df.count(), len(df.columns)
