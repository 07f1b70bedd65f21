"""Shape, nulls, signs, duplicates and frequent values of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.columns import one_row_each
from tillroll.operators.ordering import asked_columns, describe_counts, value_counts
from tillroll.staging import stage


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, T.StringType)]


def timestamp_columns(df: DataFrame) -> list[str]:
    """Columns of dates and of timestamps, with a time zone or without."""
    kinds = (T.TimestampNTZType, T.TimestampType, T.DateType)
    return [field.name for field in df.schema.fields if isinstance(field.dataType, kinds)]


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and share of nulls per column, in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"nulls_{i}") for i, name in enumerate(df.columns)],
    )
    rows = [
        [
            F.lit(name).alias("column"),
            F.col(f"nulls_{i}").alias("nulls"),
            (F.col(f"nulls_{i}") / F.nullif(F.col("rows"), F.lit(0))).alias("null_ratio"),
        ]
        for i, name in enumerate(df.columns)
    ]
    return counted.select(one_row_each(*rows))


def null_patterns(df: DataFrame) -> DataFrame:
    """Rows per combination of missing columns; 1 marks a missing value."""
    flags = [F.col(name).isNull().cast("int").alias(name) for name in df.columns]
    return df.select(*flags).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("rows"))


def sign_audit(df: DataFrame) -> DataFrame:
    """Negative and zero quantities and prices."""
    checks = {
        "negative_quantity": F.col("quantity") < 0,
        "zero_quantity": F.col("quantity") == 0,
        "negative_price": F.col("price") < 0,
        "zero_price": F.col("price") == 0,
    }
    return df.agg(*[F.count_if(check).alias(name) for name, check in checks.items()])


def dataset_overview(df: DataFrame) -> DataFrame:
    """Position, type and non-null count of each column, with rows, columns and copies.

    Equal rows are counted into groups once, and everything is summed from these.
    """
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))
    totals = groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
        *[
            F.coalesce(F.sum(F.when(F.col(name).isNotNull(), F.col("copies"))), F.lit(0)).alias(f"present_{i}")
            for i, name in enumerate(df.columns)
        ],
    )
    rows = [
        [
            F.lit(i).alias("position"),
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.col(f"present_{i}").alias("non_null"),
            F.col("rows"),
            F.lit(len(df.columns)).alias("columns"),
            F.col("duplicate_rows"),
        ]
        for i, field in enumerate(df.schema.fields)
    ]
    return totals.select(one_row_each(*rows))


def numeric_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of numeric columns."""
    columns = columns or numeric_columns(df)
    return describe_counts(value_counts(df, columns), columns)


def date_summary(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, extremes and exact quartiles of dates and timestamps, as timestamps without a zone.

    A date counts as its midnight, and a timestamp with a zone as the time in the session's.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    columns = columns or timestamp_columns(df)
    seconds = df.select(
        *[(F.col(name).cast("timestamp_ntz") - epoch).cast("interval second").cast("decimal(20,6)").alias(name) for name in columns]
    )
    summary = describe_counts(value_counts(seconds, columns), columns)

    def moment(name: str):
        return epoch + F.make_dt_interval(secs=F.col(name).cast("decimal(18,6)"))

    return summary.select(
        "column", "count", *[moment(name).alias(name) for name in ("mean", "min", "q25", "q50", "q75", "max")]
    )


def top_values(df: DataFrame, columns: list[str] | None = None, k: int = 5) -> DataFrame:
    """Distinct values per text column and its ``k`` most frequent ones as shares of non-null rows.

    All columns are counted in one pass; only counted values are shuffled. A column without
    a value has one row, with no value and no distinct ones.
    """
    columns = columns or text_columns(df)
    values = df.select(*columns).unpivot([], columns, "column", "value").filter("value IS NOT NULL")
    counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("present"), F.count(F.lit(1)).alias("distinct_values")
    )
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    top = counts.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= k)
    # At most k rows per column of the frame.
    found = F.broadcast(top.join(totals, "column"))
    return asked_columns(df, columns).join(found, "column", "left").select(
        "column",
        F.coalesce("distinct_values", F.lit(0)).alias("distinct_values"),
        "position",
        "value",
        (F.col("n") / F.col("present")).alias("share"),
    )


def frequent_texts(df: DataFrame, condition, k: int) -> DataFrame:
    """The ``k`` most frequent descriptions that meet a condition."""
    texts = df.filter(F.col("description").isNotNull() & condition).groupBy("description")
    return texts.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "description").limit(k)


def short_descriptions(df: DataFrame, shorter_than: int = 5, k: int = 20) -> DataFrame:
    return frequent_texts(df, F.length("description") < shorter_than, k)


def question_descriptions(df: DataFrame, k: int = 10) -> DataFrame:
    return frequent_texts(df, F.col("description").contains("?"), k)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def head_and_tail(df: DataFrame, by: str, columns: list[str], k: int = 50) -> DataFrame:
    """The first and last ``k`` rows in descending order of ``by``, both numbered from the end.

    Remaining ties go by all columns, so the choice does not depend on the layout. ``df`` is
    computed once and staged, as both ends read it.
    """
    df = stage(df, "ends")
    others = [name for name in df.columns if name != by]
    ends = {
        "head": [F.col(by).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in others]],
        "tail": [F.col(by).asc_nulls_first(), *[F.col(name).desc_nulls_first() for name in others]],
    }
    # Either part has at most k rows, so numbering them in one task is cheap.
    parts = [
        df.orderBy(*order)
        .limit(k)
        .select(
            F.lit(name).alias("part"),
            F.row_number().over(Window.partitionBy(F.lit(name)).orderBy(*order)).alias("position"),
            *columns,
        )
        for name, order in ends.items()
    ]
    return parts[0].unionAll(parts[1])


def extreme_quantities(df: DataFrame, k: int = 50) -> DataFrame:
    return head_and_tail(df, "quantity", ["description", "stock_code", "price", "quantity"], k)


def date_extremes(df: DataFrame, k: int = 50) -> DataFrame:
    return head_and_tail(df, "invoice_date", ["country", "revenue", "invoice_date"], k)


def priciest_products(df: DataFrame, k: int = 1000) -> DataFrame:
    """Distinct descriptions and codes among the ``k`` dearest rows, with where they first occur."""
    others = [name for name in df.columns if name != "price"]
    order = [F.col("price").desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in others]]
    top = df.orderBy(*order).limit(k)
    placed = top.withColumn("position", F.row_number().over(Window.partitionBy(F.lit(k)).orderBy(*order)))
    return (
        placed.select("position", "description", "stock_code")
        .unpivot("position", ["description", "stock_code"], "kind", "value")
        .groupBy("kind", "value")
        .agg(F.min("position").alias("first_position"))
    )
