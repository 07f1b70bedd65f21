from pathlib import Path
from types import SimpleNamespace

from tillroll import staging


def session(**settings):
    names = {key.replace("__", "."): value for key, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: names.get(key, *default)))


def test_the_shared_folder_is_that_of_the_session():
    found = staging.shared_folder(session(spark__checkpoint__dir="hdfs://x/shared/", spark__sql__warehouse__dir="y"))
    assert found == "hdfs://x/shared"


def test_without_it_the_warehouse_is_used():
    assert staging.shared_folder(session(spark__sql__warehouse__dir="hdfs://x/warehouse")) == "hdfs://x/warehouse/staged"


def test_release_leaves_nothing(spark):
    staging.stage(spark.range(5))
    database = staging.scratch_database(spark)
    spark.sql(f"CREATE DATABASE {database}")
    spark.range(3).write.saveAsTable(f"{database}.numbers")
    staging.release(spark)
    assert not Path(staging.application_folder(spark)).exists()
    assert database not in {found.name for found in spark.catalog.listDatabases()}


def test_stage_cuts_lineage(spark):
    df = staging.stage(spark.range(5).selectExpr("id", "id * 2 AS twice"))
    assert "Range" not in df._jdf.queryExecution().toString()
    assert sorted(df.collect()) == [(i, 2 * i) for i in range(5)]


def test_stage_each_has_a_table_per_value(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "k string, v int")
    parts = staging.stage_each(df, "k", ["a", "b"])
    assert sorted(row.v for row in parts["a"].collect()) == [1, 3] and parts["b"].columns == ["v"]


def test_stage_compact_keeps_rows_and_the_setting(spark):
    before = spark.conf.get(staging.CLEANUP, None)
    df = spark.range(50).selectExpr("id % 7 AS k", "id AS v").repartition("k")
    assert sorted(staging.stage_compact(df).collect()) == sorted(df.collect())
    assert spark.conf.get(staging.CLEANUP, None) == before
