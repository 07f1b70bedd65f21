"""Every query by name: (session, folder of the order tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import cleaning, clustering, customers, distributions, ordering, profiling
from tillroll.operators import reconcile as comparison
from tillroll.operators import sampling, scoring, trends
from tillroll.operators import sketches as monthly
from tillroll.plans import cleaning as clean_plan
from tillroll.plans import features as feature_plan
from tillroll.sources import files, sorted_tables, tables
from tillroll.sources.order_tables import invoice_lines
from tillroll.sources.schemas import PROCESSED_TRANSACTIONS, RAW_TRANSACTIONS, SUBSCRIBER_CONTRACTS, check_contract
from tillroll.staging import new_path, scratch_database, stage, stage_compact

Query = Callable[[SparkSession, str], DataFrame]

def plain(df: DataFrame) -> DataFrame:
    """Exact decimals as doubles, the type in which engines can be compared."""
    return df.select(
        *[
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType)
            else F.col(f"`{field.name}`")
            for field in df.schema.fields
        ]
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles whose last digits depend on the order of a sum, rounded."""
    return plain(df).select(
        *[
            F.round(F.col(f"`{field.name}`"), digits).alias(field.name)
            if isinstance(field.dataType, T.DoubleType)
            else F.col(f"`{field.name}`")
            for field in plain(df).schema.fields
        ]
    )


def on_raw(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plain(build(invoice_lines(spark, folder)))


def on_valid(build: Callable[[DataFrame], DataFrame]) -> Query:
    return on_raw(lambda raw: build(clean_plan.valid_lines(raw)))


def on_lines(build: Callable[[DataFrame], DataFrame]) -> Query:
    return on_raw(lambda raw: build(clean_plan.product_lines(raw)))


def on_clean(build: Callable[[DataFrame], DataFrame]) -> Query:
    return on_raw(lambda raw: build(clean_plan.clean_transactions(raw)))


def on_core(build: Callable[[DataFrame], DataFrame]) -> Query:
    return on_raw(lambda raw: build(feature_plan.core_from_raw(raw)))


def on_features(build: Callable[[DataFrame], DataFrame]) -> Query:
    return on_raw(lambda raw: build(feature_plan.customer_features_from_raw(raw)))


SCORE_COLUMNS = ["customer_id", "recency_score", "frequency_score", "monetary_score"]


def scores(rule: str) -> Callable[[DataFrame], DataFrame]:
    return lambda core: scoring.add_scores(customers.add_recency(core), rule=rule).select(*SCORE_COLUMNS)


def ranks(core: DataFrame) -> DataFrame:
    ranked = ordering.rank_rows(customers.add_recency(core), "customer_id", list(scoring.SCORES))
    return ranked.withColumnRenamed("column", "metric")


def reconcile_rules(core: DataFrame) -> DataFrame:
    """The features with evenly filled buckets against those with cut ranks, all edges looked up at once."""
    edges = scoring.bucket_edges(customers.add_recency(core), rules=["rank_cut", "ntile"])
    cut = feature_plan.features_from_core(core, "rank_cut", edges)
    return comparison.reconcile(cut, feature_plan.features_from_core(core, "ntile", edges), "customer_id")


def reconcile_cleaning(raw: DataFrame) -> DataFrame:
    """Raw lines against clean ones by invoice, of which either side has many lines."""
    raw = stage_compact(raw, "raw")
    clean = clean_plan.clean_transactions(raw)
    left = raw.select("invoice", "stock_code", "description", "quantity", "price", "country")
    right = clean.select("invoice", "stock_code", "description", "quantity", "price", "revenue", "year")
    return comparison.reconcile(left, stage_compact(right, "right"), "invoice")


def kmeans_fixed_point(features: DataFrame) -> DataFrame:
    features = stage(features, "features")
    model = clustering.fit_clusters(features, max_iterations=500, tolerance=1e-9)
    return clustering.check_fixed_point(model, features)


SKETCHED = ["quantity", "price", "customer_id", "stock_code", "country"]


def sketch_bounds(transactions: DataFrame) -> DataFrame:
    """Stored sketches merged over three years and a half, against the exact figures of these months."""
    transactions = stage(transactions, "transactions")
    sketches = stage(monthly.monthly_sketches(transactions, SKETCHED), "sketches")
    summary = stage(monthly.sketched_summary(sketches, (1996, 3), (1999, 8)), "summary")
    month = F.col("year") * 12 + F.col("month")
    inside = transactions.filter(month.between(1996 * 12 + 3, 1999 * 12 + 8))
    return monthly.check_sketches(inside, summary, SKETCHED)


def dated(raw: DataFrame) -> DataFrame:
    """Every kind of date, and columns without a value."""
    return raw.select(
        "invoice_date",
        F.to_date("invoice_date").alias("day"),
        F.col("invoice_date").cast("timestamp").alias("moment"),
        F.lit(None).cast("date").alias("never"),
        F.lit(None).cast("double").alias("nothing"),
        "quantity",
        F.lit(None).cast("string").alias("silent"),
        "country",
    )


def gappy(raw: DataFrame) -> DataFrame:
    """Numbers that miss in different rows: returns have no price, small sales no quantity."""
    return raw.selectExpr(
        "if(quantity BETWEEN 1 AND 9, NULL, quantity) AS quantity", "if(quantity < 0, NULL, price) AS price", "customer_id"
    )


def kmeans(features: DataFrame) -> DataFrame:
    features = stage(features, "features")
    return clustering.assign_clusters(clustering.fit_clusters(features), features)


def scratch_csv(df: DataFrame, name: str, first: str | None = None) -> str:
    """A compressed CSV of ``df`` in the shared folder; returns its path."""
    path = new_path(df.sparkSession, name)
    files.write_csv(df, path, first, compression="gzip")
    return path


def raw_csv(raw: DataFrame) -> DataFrame:
    """Raw lines written under their original headers, then read as the raw file is."""
    path = scratch_csv(raw.toDF(*RAW_TRANSACTIONS.fieldNames()), "raw-csv")
    return files.read_raw_transactions(raw.sparkSession, path)


def dirty_csv(raw: DataFrame) -> str:
    """Raw lines as a CSV in which some quantities and dates are no values of their types."""
    text = {name: F.col(name).cast("string") for name in raw.columns}
    text["quantity"] = F.when(F.col("quantity") % 17 == 3, F.concat(text["quantity"], F.lit("pcs"))).otherwise(text["quantity"])
    late = (F.col("stock_code") == "POST") & (F.col("quantity") % 2 == 0)
    text["invoice_date"] = F.when(late, F.lit("someday")).otherwise(text["invoice_date"])
    return scratch_csv(raw.select(*text.values()).toDF(*RAW_TRANSACTIONS.fieldNames()), "dirty-csv")


def bad_rows(raw: DataFrame) -> DataFrame:
    """The malformed rows of a CSV, and the columns they are malformed in."""
    return files.bad_rows(raw.sparkSession, dirty_csv(raw), RAW_TRANSACTIONS).select("record", "problem")


def typed_tier(raw: DataFrame) -> DataFrame:
    """Raw lines landed as a typed tier; a malformed file that comes later changes nothing."""
    spark = raw.sparkSession
    # Both files are written from it.
    raw = stage(raw, "raw")
    path, target = scratch_csv(raw.toDF(*RAW_TRANSACTIONS.fieldNames()), "raw-csv"), new_path(spark, "tier")
    files.typed_tier(spark, path, target, RAW_TRANSACTIONS)
    try:
        files.typed_tier(spark, dirty_csv(raw), target, RAW_TRANSACTIONS, force=True)
    except files.MalformedRows:
        pass
    return raw.sparkSession.read.parquet(target).toDF(*raw.columns)


def feature_csv(features: DataFrame) -> DataFrame:
    """The features written as CSV with the key first, and read back."""
    spark = features.sparkSession
    features = features.select(*reversed(features.columns))
    path = scratch_csv(features, "feature-csv", first="customer_id")
    key_first = features.select("customer_id", *[c for c in features.columns if c != "customer_id"])
    return files.read_csv(spark, path, key_first.schema)


def csv_round_trip(transactions: DataFrame) -> DataFrame:
    """The processed table written as CSV and read back with its types."""
    return files.read_processed_transactions(transactions.sparkSession, scratch_csv(transactions, "processed-csv"))


def table_load(transactions: DataFrame) -> DataFrame:
    """The processed CSV loaded into a typed table of a new database and read back."""
    spark = transactions.sparkSession
    path = scratch_csv(transactions, "processed-csv")
    database = scratch_database(spark)
    tables.create_database(spark, database, new_path(spark, "database"))
    tables.create_transactions_table(spark, database, "transactions")
    tables.load_transactions(spark, path, database, "transactions")
    return tables.read_table(spark, database, "transactions")


def feature_table(features: DataFrame) -> DataFrame:
    """The features as a table created from a query, and read back."""
    spark = features.sparkSession
    database = scratch_database(spark)
    tables.create_database(spark, database, new_path(spark, "database"))
    tables.replace_table(features, database, "featured")
    return tables.read_table(spark, database, "featured")


def landed(raw: DataFrame) -> DataFrame:
    """Raw lines landed once as Parquet; the second landing finds data and is skipped."""
    path = new_path(raw.sparkSession, "raw")
    files.land(raw, path)
    files.land(raw.limit(0), path)
    return raw.sparkSession.read.parquet(path)


QUERIES: dict[str, Query] = {
    # Sources, sinks and contracts
    "landed_raw": on_raw(landed),
    "raw_csv": on_raw(raw_csv),
    "bad_rows": on_raw(bad_rows),
    "typed_tier": on_raw(typed_tier),
    "feature_csv": on_features(feature_csv),
    "csv_round_trip": on_clean(csv_round_trip),
    "table_load": on_clean(table_load),
    "feature_table": on_features(feature_table),
    "sorted_features": on_features(lambda features: sorted_tables.sorted_copy(features, "customer_id", 16)),
    "contract_check": on_clean(lambda tx: check_contract(tx, PROCESSED_TRANSACTIONS)),
    "subscriber_contracts": on_raw(
        lambda raw: reduce(DataFrame.unionByName, [check_contract(raw, contract) for contract in SUBSCRIBER_CONTRACTS])
    ),
    # Cleaning and data quality
    "transactions_enriched": on_raw(
        lambda raw: raw.transform(cleaning.add_revenue).transform(cleaning.add_calendar)
    ),
    "filter_positive_price": on_raw(cleaning.keep_positive_prices),
    "drop_null_customer": on_raw(cleaning.keep_known_customers),
    "strip_description": on_raw(cleaning.strip_descriptions),
    "contradictory_cancellations": on_raw(cleaning.list_contradictory_cancellations),
    "drop_contradictory_cancellations": on_raw(cleaning.drop_contradictory_cancellations),
    "dedupe_exact": on_raw(cleaning.drop_exact_duplicates),
    "drop_non_product_codes": on_raw(cleaning.drop_non_product_codes),
    "drop_non_product_text": on_raw(cleaning.drop_non_product_text),
    "drop_negative_balance": on_raw(clean_plan.balanced_lines),
    "valid_lines": on_valid(lambda lines: lines),
    "clean_transactions": on_clean(lambda tx: tx),
    "cleaning_funnel": on_raw(clean_plan.cleaning_funnel),
    "returns_listing": on_raw(cleaning.list_returns),
    "stock_code_listing": on_raw(lambda raw: cleaning.list_stock_code(raw, "POST")),
    "sign_audit": on_raw(profiling.sign_audit),
    "duplicate_rows": on_raw(cleaning.list_duplicate_rows),
    "null_profile": on_raw(profiling.null_profile),
    "null_patterns": on_raw(profiling.null_patterns),
    # Profiling and statistics
    "dataset_overview": on_raw(profiling.dataset_overview),
    "top_values": on_raw(profiling.top_values),
    "numeric_summary": lambda spark, folder: rounded(
        profiling.numeric_summary(invoice_lines(spark, folder))
    ),
    "date_summary": on_raw(profiling.date_summary),
    "customer_revenue_stats": lambda spark, folder: rounded(
        profiling.numeric_summary(
            customers.customer_revenue(clean_plan.product_lines(invoice_lines(spark, folder))), ["revenue"]
        )
    ),
    "spearman": lambda spark, folder: rounded(
        distributions.spearman(clean_plan.clean_transactions(invoice_lines(spark, folder)))
    ),
    "spearman_with_nulls": lambda spark, folder: rounded(distributions.spearman(gappy(invoice_lines(spark, folder)))),
    "box_stats": lambda spark, folder: rounded(
        distributions.box_stats(clean_plan.clean_transactions(invoice_lines(spark, folder)))
    ),
    "length_histogram": on_clean(distributions.length_histogram),
    "short_descriptions": on_clean(profiling.short_descriptions),
    "question_descriptions": on_clean(profiling.question_descriptions),
    "signed_log_histogram": lambda spark, folder: rounded(
        distributions.signed_log_histogram(clean_plan.clean_transactions(invoice_lines(spark, folder)))
    ),
    "density": lambda spark, folder: rounded(
        distributions.density(clean_plan.clean_transactions(invoice_lines(spark, folder)))
    ),
    "sample_exact": on_clean(lambda tx: sampling.sample_rows(tx, 20_000)),
    "sample_with_copies": on_raw(lambda raw: sampling.sample_rows(raw, 20_000)),
    "extreme_quantities": on_lines(profiling.extreme_quantities),
    "date_extremes": on_clean(profiling.date_extremes),
    "priciest_products": on_valid(profiling.priciest_products),
    # Trends
    "revenue_by_year": on_clean(lambda tx: trends.revenue_by(tx, "year")),
    "revenue_by_month": on_clean(trends.revenue_by_month),
    "revenue_by_product": on_clean(lambda tx: trends.revenue_by(tx, "year", "stock_code", "description")),
    "revenue_by_country": on_clean(lambda tx: trends.revenue_by(tx, "year", "country")),
    "revenue_pivot": on_clean(trends.revenue_pivot),
    "top_products_by_year": on_clean(trends.top_products_by_year),
    "top_countries_by_year": on_clean(trends.top_countries_by_year),
    "country_share": on_clean(trends.country_share),
    "customer_country_counts": on_clean(trends.customer_country_counts),
    "daily_counts": on_clean(trends.daily_counts),
    "distinct_years": on_clean(lambda tx: profiling.distinct_values(tx, "year")),
    "zero_days": on_clean(lambda tx: trends.zero_day_report(trends.daily_counts(tx))),
    # Customers
    "customer_core": on_clean(customers.customer_core),
    "recency_days": on_core(
        lambda core: customers.add_recency(core).select("customer_id", "last_purchase", "recency")
    ),
    "sales_returns": on_core(lambda core: core.select("customer_id", "total_sales", "total_returns")),
    "return_ratio": on_core(lambda core: customers.add_return_ratio(core).select("customer_id", "return_ratio")),
    "avg_order_value": on_core(
        lambda core: customers.add_average_order_value(core).select("customer_id", "avg_order_value")
    ),
    "interpurchase_days": on_clean(customers.interpurchase_days),
    "invoice_gaps": on_clean(customers.invoice_gaps),
    "tenure_days": on_clean(customers.tenure_days),
    # Scores, segments and features
    "rank_first": on_core(ranks),
    "ntile_scores": on_core(scores("ntile")),
    "rank_cut_scores": on_core(scores("rank_cut")),
    "segments": on_features(lambda features: features.select("customer_id", "r_f_score", "segment")),
    "customer_features": on_features(lambda features: features),
    "customer_features_rank_cut": on_raw(
        lambda raw: feature_plan.customer_features_from_raw(raw, "rank_cut")
    ),
    "customer_features_join": on_clean(
        lambda tx: feature_plan.customer_features_joined(stage(tx, "transactions"))
    ),
    "segment_profile": lambda spark, folder: rounded(
        scoring.segment_profile(feature_plan.customer_features_from_raw(invoice_lines(spark, folder)))
    ),
    "feature_overview": on_features(lambda features: profiling.dataset_overview(plain(features))),
    "feature_summary": lambda spark, folder: rounded(
        profiling.numeric_summary(feature_plan.customer_features_from_raw(invoice_lines(spark, folder)))
    ),
    "feature_top_values": on_features(profiling.top_values),
    "reconcile_features": on_core(reconcile_rules),
    "kmeans_fixed_point": on_features(kmeans_fixed_point),
    "sketch_bounds": on_clean(sketch_bounds),
    "date_summary_kinds": on_raw(lambda raw: profiling.date_summary(dated(raw))),
    "numeric_summary_empty": lambda spark, folder: rounded(profiling.numeric_summary(dated(invoice_lines(spark, folder)))),
    "top_values_empty": on_raw(lambda raw: profiling.top_values(dated(raw))),
    "reconcile_cleaning": on_raw(reconcile_cleaning),
    "kmeans_clusters": on_features(kmeans),
}
