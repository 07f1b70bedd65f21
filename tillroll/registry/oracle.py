"""Independent SQL for every query, for an engine that sees the same Parquet tables."""

from __future__ import annotations

RAW = """
once AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS invoice,
         CASE WHEN l_partkey % 97 = 0 THEN 'POST' ELSE CAST(l_partkey AS VARCHAR) END AS stock_code,
         CASE WHEN l_partkey % 83 = 0 THEN NULL
              WHEN l_partkey % 79 = 0 THEN p_name || ' Manual'
              WHEN l_partkey % 73 = 0 THEN '  ' || p_name || ' '
              WHEN l_partkey % 71 = 0 THEN 'damaged?'
              WHEN l_partkey % 67 = 0 THEN substr(p_name, 1, 3)
              ELSE p_name END AS description,
         CAST(CASE WHEN l_returnflag = 'R' AND o_orderkey % 41 <> 0
                   THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS invoice_date,
         CAST(CASE WHEN l_partkey % 89 = 0 THEN 0 ELSE l_extendedprice END AS DECIMAL(10,2)) AS price,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS customer_id,
         n_name AS country
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE abs(quantity) % 25 = 0)"""

NOT_PRODUCT_CODE = """stock_code IN
  ('POST', 'DOT', 'M', 'D', 'C2', 'S', 'AMAZONFEE', 'BANK CHARGES', 'PADS', 'CRUK')"""
NOT_PRODUCT_TEXT = """regexp_matches(lower(description),
  'manual|postage|dotcom postage|bank charges|amazon fee|discount|cruk commission|adjust|carriage')"""

VALID = f"""{RAW},
valid AS (
  SELECT DISTINCT invoice, stock_code, trim(description) AS description, quantity, invoice_date,
         price, customer_id, country
  FROM raw
  WHERE price > 0 AND customer_id IS NOT NULL AND NOT (invoice LIKE 'C%' AND quantity > 0))"""

LINES = f"""{VALID},
lines AS (
  SELECT *, quantity * price AS revenue FROM valid
  WHERE NOT coalesce({NOT_PRODUCT_CODE}, false) AND NOT coalesce({NOT_PRODUCT_TEXT}, false))"""

CLEAN = f"""{LINES},
tx AS (
  SELECT *, CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month
  FROM lines
  WHERE customer_id NOT IN (
    SELECT customer_id FROM lines GROUP BY customer_id HAVING sum(revenue) < 0))"""

CORE = f"""{CLEAN},
core AS (
  SELECT customer_id, max(invoice_date) AS last_purchase, count(DISTINCT invoice) AS frequency,
         sum(revenue) AS monetary,
         sum(CASE WHEN revenue > 0 THEN revenue ELSE 0 END) AS total_sales,
         sum(CASE WHEN revenue < 0 THEN -revenue ELSE 0 END) AS total_returns
  FROM tx GROUP BY customer_id),
measured AS (
  SELECT *, CAST(extract(day FROM (SELECT max(last_purchase) FROM core) - last_purchase) AS INTEGER) AS recency,
         coalesce(CAST(total_returns AS DOUBLE) / nullif(CAST(total_sales AS DOUBLE), 0), 0) AS return_ratio,
         CAST(monetary AS DOUBLE) / CAST(frequency AS DOUBLE) AS avg_order_value
  FROM core),
ranked AS (
  SELECT *, count(*) OVER () AS n,
         row_number() OVER (ORDER BY recency, customer_id) AS recency_rank,
         row_number() OVER (ORDER BY frequency, customer_id) AS frequency_rank,
         row_number() OVER (ORDER BY monetary, customer_id) AS monetary_rank
  FROM measured)"""

NTILE = f"""{CORE},
scored AS (
  SELECT *, CAST(6 - ntile(5) OVER (ORDER BY recency, customer_id) AS INTEGER) AS recency_score,
         CAST(ntile(5) OVER (ORDER BY frequency, customer_id) AS INTEGER) AS frequency_score,
         CAST(ntile(5) OVER (ORDER BY monetary, customer_id) AS INTEGER) AS monetary_score
  FROM measured)"""


def cut(rank: str) -> str:
    return f"greatest(1, (5 * ({rank} - 1) + n - 2) // (n - 1))"


RANK_CUT = f"""{CORE},
scored AS (
  SELECT *, CAST(6 - {cut('recency_rank')} AS INTEGER) AS recency_score,
         CAST({cut('frequency_rank')} AS INTEGER) AS frequency_score,
         CAST({cut('monetary_rank')} AS INTEGER) AS monetary_score
  FROM ranked)"""


def feature_rows(scored: str, name: str = "features") -> str:
    return f"""
{name} AS (
  SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
         recency_score, frequency_score, monetary_score,
         CAST(recency_score AS VARCHAR) || CAST(frequency_score AS VARCHAR) AS r_f_score,
         CASE WHEN recency_score <= 2 AND frequency_score <= 2 THEN 'hibernating'
              WHEN recency_score <= 2 AND frequency_score <= 4 THEN 'at_risk'
              WHEN recency_score <= 2 THEN 'cant_lose'
              WHEN recency_score = 3 AND frequency_score <= 2 THEN 'about_to_sleep'
              WHEN recency_score = 3 AND frequency_score = 3 THEN 'need_attention'
              WHEN recency_score <= 4 AND frequency_score >= 4 THEN 'loyal_customers'
              WHEN recency_score = 4 AND frequency_score = 1 THEN 'promising'
              WHEN recency_score = 5 AND frequency_score = 1 THEN 'new_customers'
              WHEN frequency_score <= 3 THEN 'potential_loyalists'
              ELSE 'champions' END AS segment,
         return_ratio, avg_order_value
  FROM {scored})"""


FEATURES = f"{NTILE},{feature_rows('scored')}"
FEATURES_CUT = f"{RANK_CUT},{feature_rows('scored')}"


def select(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


RAW_COLUMNS = [
    "invoice",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "price",
    "customer_id",
    "country",
]
RAW_LIST = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c == "price" else c for c in RAW_COLUMNS)
LINE_LIST = f"{RAW_LIST}, CAST(revenue AS DOUBLE) AS revenue"
TX_LIST = f"{LINE_LIST}, year, month"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def describe(column: str, source: str, rounding: int = 6) -> str:
    value = f"CAST({column} AS DOUBLE)"
    quartiles = ", ".join(
        f"round(quantile_cont({value}, {q}), {rounding}) AS {name}"
        for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    )
    return f"""SELECT '{column}' AS "column", count({column}) AS count,
  round(CAST(sum({column}) AS DOUBLE) / count({column}), {rounding}) AS mean,
  round(stddev_samp({value}), {rounding}) AS std,
  round(min({value}), {rounding}) AS min, {quartiles}, round(max({value}), {rounding}) AS max FROM {source}"""


def moment(seconds: str) -> str:
    return f"TIMESTAMP '1970-01-01' + to_microseconds(CAST(round(({seconds}) * 1000000) AS BIGINT))"


def describe_dates(name: str, date: str) -> str:
    return f"""SELECT '{name}' AS "column", count(*) AS count,
  {moment(f"CAST(sum(CAST(epoch({date}) AS BIGINT)) AS DOUBLE) / count(*)")} AS mean,
  min({date}) AS min,
  {moment(f"quantile_cont(epoch({date}), 0.25)")} AS q25,
  {moment(f"quantile_cont(epoch({date}), 0.5)")} AS q50,
  {moment(f"quantile_cont(epoch({date}), 0.75)")} AS q75,
  max({date}) AS max FROM raw"""


def box(column: str) -> str:
    value = f"CAST({column} AS DOUBLE)"
    return f"""SELECT '{column}' AS "column", tx.year, count(*) AS count, round(any_value(q25), 6) AS q25,
  round(any_value(q50), 6) AS q50, round(any_value(q75), 6) AS q75,
  round(least(min({value}) FILTER (WHERE {value} BETWEEN q25 - (q75 - q25) * 1.5 AND q75 + (q75 - q25) * 1.5),
        any_value(q25)), 6) AS whisker_low,
  round(greatest(max({value}) FILTER (WHERE {value} BETWEEN q25 - (q75 - q25) * 1.5 AND q75 + (q75 - q25) * 1.5),
           any_value(q75)), 6) AS whisker_high,
  count(*) FILTER (WHERE NOT {value} BETWEEN q25 - (q75 - q25) * 1.5 AND q75 + (q75 - q25) * 1.5) AS outliers
FROM tx JOIN (SELECT year, quantile_cont({value}, 0.25) AS q25, quantile_cont({value}, 0.5) AS q50,
                     quantile_cont({value}, 0.75) AS q75 FROM tx GROUP BY year) q ON tx.year = q.year
GROUP BY tx.year"""


def top_values(column: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", distinct_values, position, value, share FROM (
  SELECT {column} AS value, count(*) OVER () AS distinct_values,
         CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) AS INTEGER) AS position,
         CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share
  FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}) WHERE position <= 5"""


def head_and_tail(source: str, by: str, columns: str, every: list[str]) -> str:
    others = [c for c in every if c != by]
    orders = {
        "head": ", ".join([f"{by} DESC NULLS LAST"] + [f"{c} ASC NULLS LAST" for c in others]),
        "tail": ", ".join([f"{by} ASC NULLS FIRST"] + [f"{c} DESC NULLS FIRST" for c in others]),
    }
    return union(
        [
            f"""SELECT '{part}' AS part, CAST(position AS INTEGER) AS position, {columns} FROM (
  SELECT *, row_number() OVER (ORDER BY {order}) AS position FROM {source}) WHERE position <= 50"""
            for part, order in orders.items()
        ]
    )


def histogram(bins: int) -> str:
    """Bins of a CTE ``counted`` (column, x)."""
    return f"""ranges AS (
  SELECT "column", CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
         CASE WHEN min(x) = max(x) THEN 1.0 / {bins} ELSE (max(x) - min(x)) / {bins} END AS width
  FROM counted GROUP BY "column"),
filled AS (
  SELECT c."column", CAST((SELECT max(b) FROM range({bins}) t(b) WHERE b = 0 OR x >= lo + b * width) AS INTEGER) AS bin, count(*) AS n
  FROM counted c JOIN ranges r ON c."column" = r."column" GROUP BY 1, 2),
bins AS (
  SELECT r."column", CAST(b AS INTEGER) AS bin, lo + b * width AS left_edge, lo + (b + 1) * width AS right_edge
  FROM ranges r, range({bins}) t(b))"""


HISTOGRAM_ROWS = """SELECT b."column", b.bin, {left} AS left_edge, {right} AS right_edge, coalesce(n, 0) AS n
FROM bins b LEFT JOIN filled f ON b."column" = f."column" AND b.bin = f.bin"""

SIGNED_LOGS = """counted AS (
  SELECT "column", sign(v) * ln(1 + abs(v)) AS x FROM (
    SELECT 'price' AS "column", CAST(price AS DOUBLE) AS v FROM {source}
    UNION ALL SELECT 'quantity', CAST(quantity AS DOUBLE) FROM {source}
    UNION ALL SELECT 'revenue', CAST(revenue AS DOUBLE) FROM {source}))"""

TX_COLUMNS = [*RAW_COLUMNS, "revenue", "year", "month"]


def sample(n: int, source: str = "tx", columns: list[str] = TX_COLUMNS) -> str:
    texts = ", ".join(
        f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns
    )
    return f"""digested AS (
  SELECT *, row_number() OVER (PARTITION BY digest) AS copy FROM (SELECT *, md5(concat_ws('|', {texts})) AS digest FROM {source})),
sampled AS (
  SELECT {', '.join(columns)} FROM digested ORDER BY md5(concat_ws('|', '42', digest, copy)), digest LIMIT {n})"""


# Returns without a price and small sales without a quantity, beside the missing customers.
GAPPY = ["quantity", "price", "customer_id"]
GAPPY_A = "CASE WHEN quantity BETWEEN 1 AND 9 THEN NULL ELSE quantity END"
GAPPY_B = "CASE WHEN quantity < 0 THEN NULL ELSE price END"

NUMERIC = ["customer_id", "quantity", "price", "revenue", "year", "month"]
AVERAGE_RANKS = "mean_ranks AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in NUMERIC
) + " FROM tx)"


def funnel() -> str:
    steps = [
        "price > 0",
        "price > 0 AND customer_id IS NOT NULL",
        "price > 0 AND customer_id IS NOT NULL AND NOT (invoice LIKE 'C%' AND quantity > 0)",
    ]
    queries = [
        "SELECT count(*) FROM raw",
        *[f"SELECT count(*) FROM raw WHERE {rule}" for rule in steps],
        "SELECT count(*) FROM valid",
        f"SELECT count(*) FROM valid WHERE NOT coalesce({NOT_PRODUCT_CODE}, false)",
        "SELECT count(*) FROM lines",
        "SELECT count(*) FROM tx",
    ]
    names = [
        "raw",
        "positive_price",
        "known_customer",
        "consistent_cancellation",
        "distinct",
        "product_code",
        "product_text",
        "non_negative_balance",
    ]
    return union(
        [
            f"SELECT CAST({i} AS INTEGER) AS step, '{name}' AS stage, ({query}) AS rows"
            for i, (name, query) in enumerate(zip(names, queries))
        ]
    )


def overview(columns: dict[str, str], source: str) -> str:
    """Rows of the overview for a CTE whose columns and types are given."""
    return union(
        [
            f"""SELECT CAST({i} AS INTEGER) AS position, '{name}' AS "column", '{kind}' AS type,
  count({name}) AS non_null, count(*) AS rows, CAST({len(columns)} AS INTEGER) AS columns,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source})) AS duplicate_rows FROM {source}"""
            for i, (name, kind) in enumerate(columns.items())
        ]
    )


RAW_TYPES = dict(
    zip(RAW_COLUMNS, ["string", "string", "string", "int", "timestamp_ntz", "decimal(10,2)", "int", "string"])
)
FEATURE_TYPES = {
    "customer_id": "int",
    "recency": "int",
    "frequency": "bigint",
    "monetary": "double",
    "recency_score": "int",
    "frequency_score": "int",
    "monetary_score": "int",
    "r_f_score": "string",
    "segment": "string",
    "return_ratio": "double",
    "avg_order_value": "double",
}


def reconciled() -> str:
    fractional = ["monetary", "return_ratio", "avg_order_value"]
    columns = [
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

    def differs(c: str) -> str:
        if c in fractional:
            return f"abs(l.{c} - r.{c}) > greatest(1e-5 * greatest(abs(l.{c}), abs(r.{c})), 1e-8)"
        return f"l.{c} IS DISTINCT FROM r.{c}"

    return union(
        [
            f"""SELECT '{c}' AS "column", 'both' AS side, count(*) FILTER (WHERE both_sides) AS compared,
  count(*) FILTER (WHERE both_sides AND {differs(c)}) AS mismatched,
  count(*) FILTER (WHERE both_sides AND {differs(c)}) * 100.0 / count(*) FILTER (WHERE both_sides)
    AS mismatch_percent,
  count(*) FILTER (WHERE r.customer_id IS NULL) AS left_only,
  count(*) FILTER (WHERE l.customer_id IS NULL) AS right_only,
  CAST(0 AS BIGINT) AS left_repeated, CAST(0 AS BIGINT) AS right_repeated
FROM (SELECT l, r, l.customer_id IS NOT NULL AND r.customer_id IS NOT NULL AS both_sides
      FROM cut_features l FULL OUTER JOIN features r ON l.customer_id = r.customer_id)"""
            for c in columns
        ]
    )


TOP_REVENUE = """SELECT year, {keys}, CAST(revenue AS DOUBLE) AS revenue, CAST(position AS INTEGER) AS position
FROM (SELECT year, {keys}, sum(revenue) AS revenue,
             row_number() OVER (PARTITION BY year ORDER BY sum(revenue) DESC, {keys}) AS position
      FROM tx WHERE {present} GROUP BY year, {keys})
WHERE position <= {k}"""

DAYS = """days AS (SELECT CAST(invoice_date AS DATE) AS day, count(*) AS n FROM tx GROUP BY 1),
daily AS (
  SELECT c.day, CAST(year(c.day) AS INTEGER) AS year, coalesce(n, 0) AS n
  FROM (SELECT CAST(d AS DATE) AS day
        FROM generate_series((SELECT CAST(min(day) AS TIMESTAMP) FROM days),
                             (SELECT CAST(max(day) AS TIMESTAMP) FROM days), INTERVAL 1 DAY) t(d)) c
  LEFT JOIN days ON c.day = days.day)"""

SCORES = "SELECT customer_id, recency_score, frequency_score, monetary_score FROM scored"

# The columns that are expected of subscribers, stage by stage.
SUBSCRIBERS = {
    "pre_wrangling": (
        7000,
        "Churn,Contract,Dependents,DeviceProtection,InternetService,MonthlyCharges,MultipleLines,OnlineBackup,"
        "OnlineSecurity,PaperlessBilling,Partner,PaymentMethod,PhoneService,SeniorCitizen,StreamingMovies,StreamingTV,"
        "TechSupport,TotalCharges,customerID,gender,tenure",
    ),
    "post_wrangling": (
        5000,
        "churn,contract,dependents,device_protection,gender,internet_service,monthly_charges,multiple_lines,online_backup,"
        "online_security,paperless_billing,partner,payment_method,phone_service,senior_citizen,streaming_movies,"
        "streaming_tv,tech_support,tenure,total_charges",
    ),
    "post_feature_engineering": (
        5000,
        "churn,contract_stability,dependents,device_protection,fiber_no_support,high_risk_new_monthly,high_risk_tenure,"
        "internet_service,manual_payment_early,monthly_charges,multiple_lines,online_backup,online_security,"
        "paperless_billing,partner,payment_method,senior_citizen,streaming_movies,streaming_tv,tech_support,tenure",
    ),
    "model_input": (
        0,
        "contract_stability,dependents,device_protection,fiber_no_support,high_risk_new_monthly,high_risk_tenure,"
        "internet_service,manual_payment_early,monthly_charges,multiple_lines,online_backup,online_security,"
        "paperless_billing,partner,payment_method,senior_citizen,streaming_movies,streaming_tv,tech_support,tenure",
    ),
}

ORACLE_SQL: dict[str, str] = {
    "landed_raw": select(RAW, f"SELECT {RAW_LIST} FROM raw"),
    "raw_csv": select(
        RAW, f"SELECT * REPLACE (CAST(customer_id AS DOUBLE) AS customer_id) FROM (SELECT {RAW_LIST} FROM raw)"
    ),
    "bad_rows": select(
        RAW,
        """SELECT concat_ws(',', invoice, coalesce(stock_code, ''), coalesce(description, ''),
    CAST(quantity AS VARCHAR) || CASE WHEN quantity % 17 = 3 THEN 'pcs' ELSE '' END,
    CASE WHEN late THEN 'someday' ELSE CAST(invoice_date AS VARCHAR) END,
    CAST(price AS VARCHAR), coalesce(CAST(customer_id AS VARCHAR), ''), country) AS record,
  concat_ws(',', CASE WHEN quantity % 17 = 3 THEN 'Quantity' END, CASE WHEN late THEN 'InvoiceDate' END) AS problem
FROM (SELECT *, stock_code = 'POST' AND quantity % 2 = 0 AS late FROM raw)
WHERE quantity % 17 = 3 OR late""",
    ),
    "typed_tier": select(
        RAW, f"SELECT * REPLACE (CAST(customer_id AS DOUBLE) AS customer_id) FROM (SELECT {RAW_LIST} FROM raw)"
    ),
    "feature_csv": select(FEATURES, "SELECT * FROM features"),
    "csv_round_trip": select(CLEAN, f"SELECT {TX_LIST} FROM tx"),
    "table_load": select(CLEAN, f"SELECT {TX_LIST} FROM tx"),
    "feature_table": select(FEATURES, "SELECT * FROM features"),
    "sorted_features": select(FEATURES, "SELECT *, row_number() OVER (ORDER BY customer_id) AS position FROM features"),
    "contract_check": select(
        CLEAN,
        """SELECT 'processed_transactions' AS contract, true AS passed, '' AS missing, '' AS unexpected,
  count(*) AS rows, CAST(1 AS INTEGER) AS min_rows FROM tx""",
    ),
    "subscriber_contracts": select(
        RAW,
        union(
            [
                f"""SELECT '{name}' AS contract, false AS passed, '{missing}' AS missing,
  '{",".join(sorted(RAW_COLUMNS))}' AS unexpected, {"count(*)" if rows else "CAST(NULL AS BIGINT)"} AS rows,
  CAST({rows} AS INTEGER) AS min_rows FROM {"raw" if rows else "range(1)"}"""
                for name, (rows, missing) in SUBSCRIBERS.items()
            ]
        ),
    ),
    "transactions_enriched": select(
        RAW,
        f"""SELECT {RAW_LIST}, CAST(quantity * price AS DOUBLE) AS revenue,
  CAST(year(invoice_date) AS INTEGER) AS year, CAST(month(invoice_date) AS INTEGER) AS month FROM raw""",
    ),
    "filter_positive_price": select(RAW, f"SELECT {RAW_LIST} FROM raw WHERE price > 0"),
    "drop_null_customer": select(RAW, f"SELECT {RAW_LIST} FROM raw WHERE customer_id IS NOT NULL"),
    "strip_description": select(RAW, f"SELECT {RAW_LIST} FROM (SELECT * REPLACE (trim(description) AS description) FROM raw)"),
    "contradictory_cancellations": select(
        RAW, f"SELECT {RAW_LIST} FROM raw WHERE starts_with(invoice, 'C') AND quantity > 0"
    ),
    "drop_contradictory_cancellations": select(
        RAW, f"SELECT {RAW_LIST} FROM raw WHERE NOT (starts_with(invoice, 'C') AND quantity > 0)"
    ),
    "dedupe_exact": select(RAW, f"SELECT DISTINCT {RAW_LIST} FROM raw"),
    "drop_non_product_codes": select(
        RAW, f"SELECT {RAW_LIST} FROM raw WHERE NOT coalesce({NOT_PRODUCT_CODE}, false)"
    ),
    "drop_non_product_text": select(
        RAW, f"SELECT {RAW_LIST} FROM raw WHERE NOT coalesce({NOT_PRODUCT_TEXT}, false)"
    ),
    "drop_negative_balance": select(CLEAN, f"SELECT {LINE_LIST} FROM tx"),
    "valid_lines": select(VALID, f"SELECT {RAW_LIST} FROM valid"),
    "clean_transactions": select(CLEAN, f"SELECT {TX_LIST} FROM tx"),
    "cleaning_funnel": select(CLEAN, funnel()),
    "returns_listing": select(RAW, f"SELECT {RAW_LIST} FROM raw WHERE quantity < 0"),
    "stock_code_listing": select(RAW, f"SELECT {RAW_LIST} FROM raw WHERE stock_code = 'POST'"),
    "sign_audit": select(
        RAW,
        """SELECT count(*) FILTER (WHERE quantity < 0) AS negative_quantity,
  count(*) FILTER (WHERE quantity = 0) AS zero_quantity,
  count(*) FILTER (WHERE price < 0) AS negative_price,
  count(*) FILTER (WHERE price = 0) AS zero_price FROM raw""",
    ),
    "duplicate_rows": select(
        RAW,
        f"""SELECT {RAW_LIST}, copy_no FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(RAW_COLUMNS)}) AS copy_no,
         count(*) OVER (PARTITION BY {', '.join(RAW_COLUMNS)}) AS copies FROM raw)
WHERE copies > 1""",
    ),
    "null_profile": select(
        RAW,
        union(
            [
                f"""SELECT '{c}' AS "column", count(*) - count({c}) AS nulls,
  CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_ratio FROM raw"""
                for c in RAW_COLUMNS
            ]
        ),
    ),
    "null_patterns": select(
        RAW,
        "SELECT "
        + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in RAW_COLUMNS)
        + ", count(*) AS rows FROM raw GROUP BY "
        + ", ".join(f"raw.{c} IS NULL" for c in RAW_COLUMNS),
    ),
    "dataset_overview": select(RAW, overview(RAW_TYPES, "raw")),
    "top_values": select(RAW, union([top_values(c, "raw") for c in ("invoice", "stock_code", "description", "country")])),
    "numeric_summary": select(RAW, union([describe(c, "raw") for c in ("quantity", "price", "customer_id")])),
    "date_summary": select(RAW, describe_dates("invoice_date", "invoice_date")),
    "date_summary_kinds": select(
        RAW,
        union(
            [
                describe_dates("invoice_date", "invoice_date"),
                describe_dates("day", "CAST(CAST(invoice_date AS DATE) AS TIMESTAMP)"),
                describe_dates("moment", "invoice_date"),
                """SELECT 'never', 0, CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP),
  CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP)""",
            ]
        ),
    ),
    "numeric_summary_empty": select(
        RAW,
        union([describe("quantity", "raw"), "SELECT 'nothing', 0, " + ", ".join(["CAST(NULL AS DOUBLE)"] * 7)]),
    ),
    "top_values_empty": select(
        RAW,
        union([top_values("country", "raw"), "SELECT 'silent', 0, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS DOUBLE)"]),
    ),
    "kmeans_fixed_point": select(
        FEATURES,
        """SELECT 'nearest centre' AS condition, count(*) AS checked, CAST(0 AS BIGINT) AS violations FROM features
UNION ALL SELECT 'mean of members', CAST(4 * 5 AS BIGINT), CAST(0 AS BIGINT)""",
    ),
    "sketch_bounds": select(
        CLEAN,
        union(
            [
                f"""SELECT '{c}' AS "column", count({c}) AS present, count(DISTINCT {c}) AS exact_distinct,
  true AS distinct_within, true AS ranks_within
FROM tx WHERE year * 12 + month BETWEEN 1996 * 12 + 3 AND 1999 * 12 + 8"""
                for c in ("quantity", "price", "customer_id", "stock_code", "country")
            ]
        ),
    ),
    "customer_revenue_stats": select(
        f"{LINES},\ntotals AS (SELECT customer_id, sum(revenue) AS revenue FROM lines GROUP BY customer_id)",
        describe("revenue", "totals"),
    ),
    "spearman": select(
        f"{CLEAN},\n{AVERAGE_RANKS}",
        union(
            [
                f"""SELECT '{a}' AS "column", """
                + ", ".join(f"round(corr({a}, {b}), 6) AS {b}" for b in NUMERIC)
                + " FROM mean_ranks"
                for a in NUMERIC
            ]
        ),
    ),
    "spearman_with_nulls": select(
        RAW + ",\n" + ",\n".join(
            f"""pair_{a}_{b} AS (
  SELECT corr(x, y) AS r FROM (
    SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS x,
           rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS y
    FROM (SELECT {GAPPY_A} AS quantity, {GAPPY_B} AS price, customer_id FROM raw)
    WHERE {a} IS NOT NULL AND {b} IS NOT NULL))"""
            for a in GAPPY for b in GAPPY
        ),
        union(
            [
                f"""SELECT '{a}' AS "column", """
                + ", ".join(f"(SELECT round(r, 6) FROM pair_{a}_{b}) AS {b}" for b in GAPPY)
                for a in GAPPY
            ]
        ),
    ),
    "reconcile_cleaning": select(
        f"""{CLEAN},
lefts AS (
  SELECT *, row_number() OVER (PARTITION BY invoice ORDER BY stock_code NULLS FIRST, description NULLS FIRST, quantity, price) AS place
  FROM raw),
rights AS (
  SELECT *, row_number() OVER (PARTITION BY invoice ORDER BY stock_code NULLS FIRST, description NULLS FIRST, quantity, price) AS place
  FROM tx),
met AS (
  SELECT l, r, l.invoice IS NOT NULL AND r.invoice IS NOT NULL AS both_sides
  FROM lefts l FULL OUTER JOIN rights r ON l.invoice = r.invoice AND l.place = r.place),
sizes AS (
  SELECT count(*) FILTER (WHERE both_sides) AS compared, count(*) FILTER (WHERE r.invoice IS NULL) AS left_only,
         count(*) FILTER (WHERE l.invoice IS NULL) AS right_only,
         (SELECT count(*) - count(DISTINCT invoice) FROM raw) AS left_repeated,
         (SELECT count(*) - count(DISTINCT invoice) FROM tx) AS right_repeated
  FROM met)""",
        union(
            [
                f"""SELECT '{c}' AS "column", 'both' AS side, compared, mismatched, mismatched * 100.0 / compared AS mismatch_percent,
  left_only, right_only, left_repeated, right_repeated
FROM sizes, (SELECT count(*) AS mismatched FROM met WHERE both_sides AND l.{c} IS DISTINCT FROM r.{c})"""
                for c in ("stock_code", "description", "quantity", "price")
            ]
            + [
                f"""SELECT '{c}', '{side}', CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DOUBLE),
  left_only, right_only, left_repeated, right_repeated FROM sizes"""
                for c, side in (("country", "left"), ("revenue", "right"), ("year", "right"))
            ]
        ),
    ),
    "box_stats": select(CLEAN, union([box("quantity"), box("price")])),
    "length_histogram": select(
        f"""{CLEAN},
counted AS (SELECT 'description' AS "column", CAST(length(description) AS DOUBLE) AS x
            FROM tx WHERE description IS NOT NULL),
{histogram(80)}""",
        HISTOGRAM_ROWS.format(left="left_edge", right="right_edge"),
    ),
    "short_descriptions": select(
        CLEAN,
        """SELECT description, count(*) AS n FROM tx WHERE length(description) < 5
GROUP BY description ORDER BY n DESC, description LIMIT 20""",
    ),
    "question_descriptions": select(
        CLEAN,
        """SELECT description, count(*) AS n FROM tx WHERE contains(description, '?')
GROUP BY description ORDER BY n DESC, description LIMIT 10""",
    ),
    "signed_log_histogram": select(
        f"{CLEAN},\n{SIGNED_LOGS.format(source='tx')},\n{histogram(50)}",
        HISTOGRAM_ROWS.format(left="round(left_edge, 6)", right="round(right_edge, 6)"),
    ),
    "density": select(
        f"""{CLEAN},
{sample(50000)},
{SIGNED_LOGS.format(source='sampled')},
grid AS (
  SELECT "column", min(x) AS lo, (max(x) - min(x)) / 199 AS step,
         stddev_samp(x) * pow(count(*), -0.2) AS width FROM counted GROUP BY "column"),
weighted AS (SELECT "column", x, count(*) AS n FROM counted GROUP BY "column", x),
points AS (SELECT "column", lo, step, width, CAST(i AS INTEGER) AS point FROM grid, range(200) t(i))""",
        """SELECT p."column", point, round(any_value(lo + point * step), 6) AS x,
  round(sum(n * exp(-0.5 * pow((w.x - lo - point * step) / width, 2)) / (width * sqrt(2 * pi()))) / sum(n), 6)
    AS density
FROM points p JOIN weighted w ON p."column" = w."column" GROUP BY p."column", point""",
    ),
    "sample_exact": select(f"{CLEAN},\n{sample(20000)}", f"SELECT {TX_LIST} FROM sampled"),
    "sample_with_copies": select(
        f"{RAW},\n{sample(20000, 'raw', RAW_COLUMNS)}", f"SELECT {RAW_LIST} FROM sampled"
    ),
    "extreme_quantities": select(
        LINES,
        head_and_tail(
            "lines",
            "quantity",
            "description, stock_code, CAST(price AS DOUBLE) AS price, quantity",
            [*RAW_COLUMNS, "revenue"],
        ),
    ),
    "date_extremes": select(
        CLEAN,
        head_and_tail(
            "tx", "invoice_date", "country, CAST(revenue AS DOUBLE) AS revenue, invoice_date", TX_COLUMNS
        ),
    ),
    "priciest_products": select(
        f"""{VALID},
top AS (
  SELECT *, row_number() OVER (ORDER BY price DESC, invoice, stock_code, description NULLS LAST, quantity,
                                        invoice_date, customer_id, country) AS position
  FROM valid)""",
        """SELECT kind, value, CAST(min(position) AS INTEGER) AS first_position FROM (
  SELECT 'description' AS kind, description AS value, position FROM top WHERE position <= 1000
  UNION ALL SELECT 'stock_code', stock_code, position FROM top WHERE position <= 1000)
GROUP BY kind, value""",
    ),
    "revenue_by_year": select(CLEAN, "SELECT year, CAST(sum(revenue) AS DOUBLE) AS revenue FROM tx GROUP BY year"),
    "revenue_by_month": select(
        CLEAN,
        """SELECT year, month, CAST(sum(revenue) AS DOUBLE) AS revenue,
  CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS year_month
FROM tx GROUP BY year, month""",
    ),
    "revenue_by_product": select(
        CLEAN,
        """SELECT year, stock_code, description, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM tx WHERE description IS NOT NULL AND stock_code IS NOT NULL GROUP BY year, stock_code, description""",
    ),
    "revenue_by_country": select(
        CLEAN, "SELECT year, country, CAST(sum(revenue) AS DOUBLE) AS revenue FROM tx GROUP BY year, country"
    ),
    "revenue_pivot": select(
        CLEAN,
        "SELECT year, "
        + ", ".join(f"CAST(sum(revenue) FILTER (WHERE month = {m}) AS DOUBLE) AS m{m}" for m in range(1, 13))
        + " FROM tx GROUP BY year",
    ),
    "top_products_by_year": select(
        CLEAN,
        TOP_REVENUE.format(
            keys="stock_code, description",
            present="stock_code IS NOT NULL AND description IS NOT NULL",
            k=10,
        ),
    ),
    "top_countries_by_year": select(CLEAN, TOP_REVENUE.format(keys="country", present="country IS NOT NULL", k=5)),
    "country_share": select(
        f"""{CLEAN},
totals AS (
  SELECT year, country, sum(revenue) AS revenue, sum(sum(revenue)) OVER (PARTITION BY year) AS year_revenue,
         row_number() OVER (PARTITION BY year ORDER BY sum(revenue) DESC, country) AS position
  FROM tx GROUP BY year, country)""",
        """SELECT year, country, CAST(revenue AS DOUBLE) AS revenue, CAST(position AS INTEGER) AS position,
  CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER (PARTITION BY year) AS DOUBLE) AS share_of_top,
  CAST(revenue AS DOUBLE) / CAST(year_revenue AS DOUBLE) AS share_of_year
FROM totals WHERE position <= 5""",
    ),
    "customer_country_counts": select(
        CLEAN,
        """SELECT customer_id, country, count(*) AS n FROM tx GROUP BY customer_id, country
ORDER BY n DESC, customer_id, country LIMIT 20""",
    ),
    "daily_counts": select(f"{CLEAN},\n{DAYS}", "SELECT day, year, n FROM daily"),
    "distinct_years": select(CLEAN, "SELECT DISTINCT year FROM tx"),
    "zero_days": select(
        f"{CLEAN},\n{DAYS}",
        """SELECT day, count(*) OVER () AS zero_days FROM daily WHERE n = 0 ORDER BY day LIMIT 20""",
    ),
    "customer_core": select(
        CORE,
        """SELECT customer_id, last_purchase, frequency, CAST(monetary AS DOUBLE) AS monetary,
  CAST(total_sales AS DOUBLE) AS total_sales, CAST(total_returns AS DOUBLE) AS total_returns FROM core""",
    ),
    "recency_days": select(CORE, "SELECT customer_id, last_purchase, recency FROM measured"),
    "sales_returns": select(
        CORE,
        """SELECT customer_id, CAST(total_sales AS DOUBLE) AS total_sales,
  CAST(total_returns AS DOUBLE) AS total_returns FROM core""",
    ),
    "return_ratio": select(CORE, "SELECT customer_id, return_ratio FROM measured"),
    "avg_order_value": select(CORE, "SELECT customer_id, avg_order_value FROM measured"),
    "interpurchase_days": select(
        f"""{CLEAN},
invoices AS (SELECT customer_id, invoice, min(invoice_date) AS day FROM tx GROUP BY customer_id, invoice)""",
        """SELECT customer_id,
  CAST(epoch(max(day)) - epoch(min(day)) AS DOUBLE) / 86400 / nullif(count(*) - 1, 0) AS avg_interpurchase_days
FROM invoices GROUP BY customer_id""",
    ),
    "invoice_gaps": select(
        f"""{CLEAN},
invoices AS (SELECT customer_id, invoice, min(invoice_date) AS invoice_date FROM tx GROUP BY customer_id, invoice)""",
        """SELECT customer_id, invoice, invoice_date, previous_invoice_date,
  CAST(epoch(invoice_date) - epoch(previous_invoice_date) AS DOUBLE) / 86400 AS gap_days
FROM (SELECT *, lag(invoice_date) OVER (PARTITION BY customer_id ORDER BY invoice_date, invoice) AS previous_invoice_date
      FROM invoices)""",
    ),
    "tenure_days": select(
        CLEAN,
        """SELECT customer_id, CAST(round_even(
    CAST(epoch((SELECT max(invoice_date) FROM tx)) - epoch(min(invoice_date)) AS DOUBLE) / 86400, 0) AS BIGINT)
  AS customer_tenure_days FROM tx GROUP BY customer_id""",
    ),
    "rank_first": select(
        CORE,
        union(
            [
                f"""SELECT customer_id, '{m}' AS metric, CAST({m} AS DOUBLE) AS value, {m}_rank AS rank FROM ranked"""
                for m in ("recency", "frequency", "monetary")
            ]
        ),
    ),
    "ntile_scores": select(NTILE, SCORES),
    "rank_cut_scores": select(RANK_CUT, SCORES),
    "segments": select(FEATURES, "SELECT customer_id, r_f_score, segment FROM features"),
    "customer_features": select(FEATURES, "SELECT * FROM features"),
    "customer_features_rank_cut": select(FEATURES_CUT, "SELECT * FROM features"),
    "customer_features_join": select(FEATURES, "SELECT * FROM features"),
    "segment_profile": select(
        FEATURES,
        """SELECT segment, count(*) AS customers, round(avg(recency), 6) AS mean_recency,
  round(avg(frequency), 6) AS mean_frequency, round(avg(monetary), 6) AS mean_monetary,
  round(avg(return_ratio), 6) AS mean_return_ratio, round(avg(avg_order_value), 6) AS mean_avg_order_value
FROM features GROUP BY segment""",
    ),
    "feature_overview": select(FEATURES, overview(FEATURE_TYPES, "features")),
    "feature_summary": select(
        FEATURES,
        union([describe(c, "features") for c, kind in FEATURE_TYPES.items() if kind != "string"]),
    ),
    "feature_top_values": select(FEATURES, union([top_values(c, "features") for c in ("r_f_score", "segment")])),
    "reconcile_features": select(
        FEATURES
        + f""",
cut_scored AS (
  SELECT *, CAST(6 - {cut('recency_rank')} AS INTEGER) AS recency_score,
         CAST({cut('frequency_rank')} AS INTEGER) AS frequency_score,
         CAST({cut('monetary_rank')} AS INTEGER) AS monetary_score
  FROM ranked),{feature_rows('cut_scored', 'cut_features')}""",
        reconciled(),
    ),
}
