import gzip
import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from frames import counted, line, settings
from pyspark.sql import functions as F

from tillroll import staging
from tillroll.operators.cleaning import add_calendar, add_revenue
from tillroll.plans.cleaning import clean_transactions
from tillroll.registry import queries
from tillroll.sources import files, sorted_tables, tables
from tillroll.sources.names import clean_column_name, clean_column_names, identifier
from tillroll.sources.schemas import (
    FEATURE_COLUMNS,
    PROCESSED_TRANSACTIONS,
    RAW_TRANSACTIONS,
    SUBSCRIBER_CONTRACTS,
    TRANSACTIONS,
    DatasetContract,
    check_contract,
)

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


@pytest.mark.parametrize(
    "name, clean",
    [
        ("Customer ID", "customer_id"),
        ("customerID", "customer_id"),
        ("StockCode", "stock_code"),
        ("StreamingTV", "streaming_tv"),
        (" Unit-Price (GBP) ", "unit_price_gbp"),
        ("price2Pay", "price2_pay"),
        ("HTTPServer", "httpserver"),
    ],
)
def test_column_names(name, clean):
    assert clean_column_name(name) == clean


def test_colliding_names_raise(spark):
    df = spark.createDataFrame([(1, 2)], ["Customer ID", "customerID"])
    with pytest.raises(ValueError, match="customer_id"):
        clean_column_names(df)


def test_raw_file(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        HEADER
        + '489434,85048,"15CM ""GLASS"", BALL",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom\n'
        + "C489435,POST,,-1,2009-12-01 07:46:00,0.001,,France\n"
    )
    df = files.read_raw_transactions(spark, str(path))
    first, second = df.collect()
    assert first.description == '15CM "GLASS", BALL' and first.customer_id == 13085.0
    assert first.invoice_date == datetime(2009, 12, 1, 7, 45) and first.price == Decimal("6.95")
    assert second.description is None and second.customer_id is None and second.price == Decimal("0.001")
    clean = clean_transactions(df).collect()
    assert [(row.customer_id, row.revenue) for row in clean] == [(13085, Decimal("83.40"))]


@pytest.mark.parametrize("bad", ["1,2,3,many,2009-12-01 07:45:00,1.0,1.0,UK\n", "1,2,3,4,someday,1.0,1.0,UK\n"])
def test_malformed_rows_fail(spark, tmp_path, bad):
    path = tmp_path / "raw.csv"
    path.write_text(HEADER + bad)
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_raw_transactions(spark, str(path)).collect()


@pytest.fixture
def dirty_folder(spark, tmp_path):
    """Three files that are read in many blocks; the bad lines of each."""
    good = '489434,85048,"15CM ""GLASS"", BALL",12,2009-12-01 07:45:00,6.95,13085.0,United Kingdom\n'
    bad = {
        7: ("1,2,3,many,2009-12-01 07:45:00,1.0,1.0,UK\n", "Quantity"),
        11: ("1,2,3,4,someday,1.0,x,UK\n", "InvoiceDate,Customer ID"),
        20: ("1,2,3\n", "number of columns"),
        23: ("1,2,3,4,2009-12-01 07:45:00,1.0,1.0,UK,9,9\n", "number of columns"),
        29: ('1,2,"a""b,c",99999999999,2009-12-01 07:45:00,1.0,1.0,UK\n', "Quantity"),
    }
    expected = []
    for i in range(3):
        lines = [HEADER, *[good] * 40]
        lines[35] = "\n"
        for line, (text, problem) in bad.items() if i else []:
            lines[line + i] = text
            expected.append((f"f{i}.csv", line + i + 1, text.rstrip("\n"), problem))
        (tmp_path / f"f{i}.csv").write_text("".join(lines))
    with settings(spark, spark__sql__files__maxPartitionBytes="300", spark__sql__files__openCostInBytes="100"):
        yield tmp_path, expected


def test_bad_rows_have_file_and_line(spark, dirty_folder):
    path, expected = dirty_folder
    found = files.bad_rows(spark, str(path), RAW_TRANSACTIONS).collect()
    assert sorted((row.file.split("/")[-1], row.line, row.record, row.problem) for row in found) == sorted(expected)
    whole = files.bad_rows(spark, str(path), RAW_TRANSACTIONS, multi_line=True).collect()
    assert sorted((row.file.split("/")[-1], row.record, row.problem) for row in whole) == sorted((e[0], *e[2:]) for e in expected)


def test_a_tier_is_complete_or_not_there(spark, dirty_folder, tmp_path_factory):
    path, expected = dirty_folder
    target = str(tmp_path_factory.mktemp("tiers") / "deep" / "raw")
    with pytest.raises(files.MalformedRows, match=f"{len(expected)} malformed rows") as caught:
        files.typed_tier(spark, str(path), target, RAW_TRANSACTIONS)
    assert caught.value.rows.count() == len(expected) and not files.holds_data(spark, target)
    assert files.typed_tier(spark, str(path / "f0.csv"), target, RAW_TRANSACTIONS).count() == 39
    with pytest.raises(files.MalformedRows):
        files.typed_tier(spark, str(path), target, RAW_TRANSACTIONS, force=True)
    assert files.typed_tier(spark, str(path), target, RAW_TRANSACTIONS).count() == 39
    # Also a query that asks for good columns only finds the bad number.
    with pytest.raises(files.MalformedRows):
        files.read_raw_transactions(spark, str(path)).select("country").collect()


def test_other_header_fails(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(HEADER.replace("Quantity,InvoiceDate", "InvoiceDate,Quantity") + "1,2,3,4,5,6,7,8\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_raw_transactions(spark, str(path)).collect()


@pytest.fixture
def processed(raw_frame):
    df = raw_frame(
        line(description='say "hi", you', when="2010-12-01 08:26:07"),
        line(invoice="C9", description=None, quantity=-3, stock_code=None),
        line(description="", when="2011-03-27 02:30:00"),
    )
    return df.transform(add_revenue).transform(add_calendar).select(
        *[df[c] if c in df.columns else c for c in TRANSACTIONS.fieldNames()]
    )


def test_processed_file_round_trip(spark, processed, tmp_path):
    path = str(tmp_path / "data" / "processed")
    files.write_csv(processed, path)
    files.write_csv(processed, path)
    back = files.read_processed_transactions(spark, path)
    assert back.schema == TRANSACTIONS
    # An empty field is null, however it came about.
    expected = processed.replace("", None, ["description"])
    assert sorted(back.collect(), key=str) == sorted(expected.collect(), key=str)


def test_feature_file_has_the_key_first(spark, tmp_path):
    df = spark.createDataFrame([(1.5, "a", 7)], ["return_ratio", "segment", "customer_id"])
    path = str(tmp_path / "featured")
    files.write_csv(df, path, first="customer_id")
    assert spark.read.option("header", True).csv(path).columns == ["customer_id", "return_ratio", "segment"]


def test_landing_is_skipped_unless_forced(spark, tmp_path):
    path = str(tmp_path / "raw")
    files.land(spark.range(3), path)
    files.land(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3
    files.land(spark.range(5), path, force=True)
    assert spark.read.parquet(path).count() == 5


@pytest.fixture
def database(spark):
    name = f"shop_{uuid.uuid4().hex}"
    tables.create_database(spark, name)
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


@pytest.mark.parametrize("name", ["a; DROP TABLE x", "", "a-b", "a.b", "x\n", "é"])
def test_unsafe_names_raise(spark, name):
    with pytest.raises(ValueError):
        tables.create_database(spark, name)
    with pytest.raises(ValueError):
        tables.create_transactions_table(spark, "shop", name)


def test_load_appends_and_rounds(spark, processed, database, tmp_path):
    name = tables.create_transactions_table(spark, database, "transactions")
    assert identifier("transactions") == "transactions"
    tables.create_transactions_table(spark, database, "transactions")
    path = tmp_path / "base.csv"
    header = ",".join(f"any{i}" for i in range(11)) + "\n"
    path.write_text(header + "1,2,x,3,2010-12-01 08:26:00,0.005,7,UK,0.015,2010,12\n")
    tables.load_transactions(spark, str(path), database, "transactions")
    tables.load_transactions(spark, str(path), database, "transactions")
    table = tables.read_table(spark, database, "transactions")
    assert tables.table_shape(table) == (2, 11)
    assert {(row.price, row.revenue) for row in table.collect()} == {(Decimal("0.01"), Decimal("0.02"))}
    assert check_contract(table, PROCESSED_TRANSACTIONS).first().passed
    assert spark.table(name).schema["invoice_date"].dataType == TRANSACTIONS["invoice_date"].dataType


@pytest.mark.parametrize(
    "row",
    [
        ",2,x,3,2010-12-01 08:26:00,1.00,7,UK,3.00,2010,12\n",
        "1,2,x,3,2010-12-01 08:26:00,1.00,7," + "U" * 101 + ",3.00,2010,12\n",
        "1,2,x,3000000000,2010-12-01 08:26:00,1.00,7,UK,3.00,2010,12\n",
    ],
    ids=["no invoice", "long country", "large quantity"],
)
def test_a_bad_row_adds_nothing(spark, database, tmp_path, row):
    tables.create_transactions_table(spark, database, "transactions")
    path = tmp_path / "base.csv"
    path.write_text(",".join(TRANSACTIONS.fieldNames()) + "\n1,2,x,3,2010-12-01 08:26:00,1.00,7,UK,3.00,2010,12\n" + row)
    with pytest.raises(Exception):
        tables.load_transactions(spark, str(path), database, "transactions")
    assert tables.read_table(spark, database, "transactions").count() == 0


def test_recreating_drops_tables(spark, database):
    tables.replace_table(spark.range(3).toDF("x"), database, "featured")
    tables.replace_table(spark.range(4).toDF("y"), database, "featured")
    assert tables.table_shape(tables.read_table(spark, database, "featured")) == (4, 1)
    tables.create_database(spark, database)
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 0


def test_contracts(spark):
    assert [(c.name, len(c.expected_columns), c.min_rows) for c in SUBSCRIBER_CONTRACTS] == [
        ("pre_wrangling", 21, 7000),
        ("post_wrangling", 20, 5000),
        ("post_feature_engineering", 21, 5000),
        ("model_input", 20, 0),
    ]
    df = spark.createDataFrame([(1, 2)], ["a", "c"])
    found = check_contract(df, DatasetContract("x", frozenset("ab"), 2)).first()
    assert tuple(found) == ("x", False, "b", "c", 1, 2)
    assert not check_contract(df, DatasetContract("x", frozenset("ac"), 2)).first().passed
    unbounded = check_contract(df, DatasetContract("x", frozenset("ac"))).first()
    assert unbounded.passed and unbounded.rows is None
    assert len(FEATURE_COLUMNS) == 11


def test_sorted_table(spark, tmp_path):
    path = str(tmp_path / "sorted")
    ids = [None, *(i * 7919 % 1000 for i in range(1000))]
    df = spark.createDataFrame([(i, str(i)) for i in ids], "id int, text string").repartition(7)
    sorted_tables.write_sorted(df, path, "id", files=9)
    index = sorted_tables.file_index(spark, path).orderBy(F.col("last")).collect()
    assert len(index) > 4 and sum(row.rows for row in index) == 1001 and sum(row.without_key for row in index) == 1
    assert all(a.last < b.first for a, b in zip(index, index[1:]))
    rows = sorted_tables.read_in_order(spark, path, "id").collect()
    assert [row.id for row in sorted(rows, key=lambda row: row.position)] == sorted(ids, key=lambda i: (i is not None, i))
    found = sorted_tables.lookup(spark, path, "id", 77)
    assert [tuple(row) for row in found.collect()] == [(77, "77")] and len(found.inputFiles()) == 1
    assert sorted_tables.lookup(spark, path, "id", None).count() == 1
    assert sorted_tables.lookup(spark, path, "id", 5000).count() == 0
    # Key ranges only touch where a key fills several files.
    hot = spark.range(4000).selectExpr("if(id < 3000, 5, id) AS id")
    ordered = sorted_tables.sorted_copy(hot, "id", 8).orderBy("position").collect()
    assert [row.id for row in ordered] == sorted(row.id for row in ordered) and len(ordered) == 4000


def test_compressed_csv(spark, processed, tmp_path):
    path = tmp_path / "packed"
    files.write_csv(processed, str(path), compression="gzip")
    assert list(path.glob("*.csv.gz")) and not list(path.glob("*.csv"))
    expected = processed.replace("", None, ["description"])
    assert sorted(files.read_processed_transactions(spark, str(path)).collect(), key=str) == sorted(expected.collect(), key=str)
    # Bad rows are found in it by line.
    with gzip.open(path / "part-x.csv.gz", "wt") as packed:
        packed.write(",".join(TRANSACTIONS.fieldNames()) + "\n1,2,x,many,2010-12-01 08:26:00,1.00,7,UK,3.00,2010,12\n")
    found = files.bad_rows(spark, str(path), TRANSACTIONS).collect()
    assert [(row.file.split("/")[-1], row.line, row.problem) for row in found] == [("part-x.csv.gz", 2, "quantity")]


@pytest.mark.parametrize("query", [queries.csv_round_trip, queries.table_load])
def test_scratch_files_of_the_processed_table_are_compressed(processed, tmp_path, monkeypatch, query):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    assert query(processed).count() == processed.count()
    assert list(tmp_path.rglob("*.csv.gz")) and not list(tmp_path.rglob("*.csv"))


def test_a_tier_and_its_dirty_file_come_from_rows_computed_once(raw_frame, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda _: str(tmp_path))
    rows = [line(quantity=q, stock_code=code) for q in range(1, 40) for code in ("POST", "1")]
    raw, seen = counted(raw_frame(*rows))
    tier = queries.typed_tier(raw)
    assert sorted(tier.select("quantity", "stock_code").collect()) == sorted((row[3], row[1]) for row in rows)
    assert seen.value == len(rows)
    assert list(tmp_path.rglob("dirty-csv-*/*.csv.gz")) and not list(tmp_path.rglob("*.csv"))
