"""Row types and dataset contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.sources.names import clean_column_name

# Raw prices keep more digits than the typed table: a price of 0.001 is positive
# while cleaning and is rounded only when it is loaded.
RAW_TRANSACTIONS = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("Price", T.DecimalType(18, 6)),
        T.StructField("Customer ID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("invoice", T.StringType()),
        T.StructField("stock_code", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("invoice_date", T.TimestampNTZType()),
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("country", T.StringType()),
        T.StructField("revenue", T.DecimalType(20, 2)),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

FEATURE_COLUMNS = [
    "customer_id",
    "recency",
    "frequency",
    "monetary",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "r_f_score",
    "segment",
    "return_ratio",
    "avg_order_value",
]


@dataclass(frozen=True)
class DatasetContract:
    """Column set and minimum size a dataset has to show at one stage."""

    name: str
    expected_columns: frozenset[str]
    min_rows: int = 0


def check_contract(df: DataFrame, contract: DatasetContract) -> DataFrame:
    """One row that tells whether ``df`` keeps ``contract`` and where it fails.

    Columns are compared as sets. Rows are counted only if a minimum is asked for.
    """
    missing = sorted(contract.expected_columns - set(df.columns))
    unexpected = sorted(set(df.columns) - contract.expected_columns)
    if contract.min_rows:
        counted = df.agg(F.count(F.lit(1)).alias("rows"))
    else:
        counted = df.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("rows"))
    enough = F.coalesce(F.col("rows") >= contract.min_rows, F.lit(True))
    return counted.select(
        F.lit(contract.name).alias("contract"),
        (F.lit(not missing and not unexpected) & enough).alias("passed"),
        F.lit(",".join(missing)).alias("missing"),
        F.lit(",".join(unexpected)).alias("unexpected"),
        "rows",
        F.lit(contract.min_rows).alias("min_rows"),
    )


PROCESSED_TRANSACTIONS = DatasetContract(
    "processed_transactions", frozenset(TRANSACTIONS.fieldNames()), 1
)

# Columns of the raw subscriber file, and the engineered columns
# that the later stages of that dataset expect.
SUBSCRIBER_COLUMNS = [
    "Churn",
    "Contract",
    "customerID",
    "Dependents",
    "DeviceProtection",
    "gender",
    "InternetService",
    "MonthlyCharges",
    "MultipleLines",
    "OnlineBackup",
    "OnlineSecurity",
    "PaperlessBilling",
    "Partner",
    "PaymentMethod",
    "PhoneService",
    "SeniorCitizen",
    "StreamingMovies",
    "StreamingTV",
    "TechSupport",
    "tenure",
    "TotalCharges",
]
SUBSCRIBER_ENGINEERED = [
    "contract_stability",
    "fiber_no_support",
    "high_risk_new_monthly",
    "high_risk_tenure",
    "manual_payment_early",
]

# Each stage follows from the one before it: names are cleaned and the id goes,
# then engineered columns replace their inputs, then the target is set aside.
_wrangled = {clean_column_name(name) for name in SUBSCRIBER_COLUMNS} - {"customer_id"}
_engineered = (_wrangled - {"contract", "gender", "phone_service", "total_charges"}) | set(
    SUBSCRIBER_ENGINEERED
)
SUBSCRIBER_CONTRACTS = [
    DatasetContract("pre_wrangling", frozenset(SUBSCRIBER_COLUMNS), 7000),
    DatasetContract("post_wrangling", frozenset(_wrangled), 5000),
    DatasetContract("post_feature_engineering", frozenset(_engineered), 5000),
    DatasetContract("model_input", frozenset(_engineered - {"churn"}), 0),
]
