"""Retail invoice lines built from the order tables (see FIXTURES.md section 3).

The order tables are clean, so every kind of dirt the pipeline has to handle is
put in by rules on the keys. The rules use nothing random: a SQL engine can build
the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns in use, so that no job has to look for the schema.
COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, "
    "l_returnflag string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "part": "p_partkey bigint, p_name string",
}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(COLUMNS[table]).parquet(f"{folder}/{table}.parquet")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return (
        load(spark, folder, "lineitem")
        .selectExpr(
            "l_orderkey",
            "l_partkey",
            "l_returnflag = 'R' AS returned",
            "CAST(if(l_returnflag = 'R' AND l_orderkey % 41 <> 0, -l_quantity, l_quantity) AS INT) AS quantity",
            "CAST(if(l_partkey % 89 = 0, 0, l_extendedprice) AS DECIMAL(10,2)) AS price",
        )
        .selectExpr("*", "explode(if(quantity % 25 = 0, array(1, 2), array(1))) AS copy")
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the country of their customer, which is looked up once per order."""
    return (
        load(spark, folder, "orders")
        .join(load(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(load(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "o_orderkey",
            "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey * 7919 % 86400) AS invoice_date",
            "CAST(if(o_orderkey % 5 = 0, NULL, o_custkey) AS INT) AS customer_id",
            "n_name AS country",
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "part").selectExpr(
        "p_partkey",
        "if(p_partkey % 97 = 0, 'POST', CAST(p_partkey AS STRING)) AS stock_code",
        """
        CASE WHEN p_partkey % 83 = 0 THEN NULL
             WHEN p_partkey % 79 = 0 THEN p_name || ' Manual'
             WHEN p_partkey % 73 = 0 THEN '  ' || p_name || ' '
             WHEN p_partkey % 71 = 0 THEN 'damaged?'
             WHEN p_partkey % 67 = 0 THEN substring(p_name, 1, 3)
             ELSE p_name END AS description
        """,
    )


def invoice_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Raw transactions: lines joined to their product and their order.

    Filters on a column reach the table it depends on, whether it is made before the joins
    or after. Numbers meet the orders, which are many and cost a shuffle of the lines; texts
    are added after that. No join is forced: sizes decide.
    """
    return (
        order_lines(spark, folder)
        .join(orders(spark, folder), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(products(spark, folder), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.expr("concat(if(returned, 'C', ''), l_orderkey)").alias("invoice"),
            "stock_code",
            "description",
            "quantity",
            "invoice_date",
            "price",
            "customer_id",
            "country",
        )
    )
