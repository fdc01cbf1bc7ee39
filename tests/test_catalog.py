"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not here")


@pytest.fixture(scope="module")
def duck():
    connection = pytest.importorskip("duckdb").connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


def check_plan(df):
    """No join without keys, no row-at-a-time Python."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan, plan


@pytest.fixture
def written_plans(monkeypatch):
    """Check the plan of every intermediate table as it is written."""
    write = DataFrameWriter.parquet

    def checked(self, *args, **kwargs):
        check_plan(self._df)
        return write(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", checked)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, written_plans, name):
    df = driver.queries()[name](spark, SF)
    check_plan(df)
    columns = sorted(df.columns)
    rows = sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
    assert rows
    if name not in driver.oracle_sql():
        return
    cursor = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert rows == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=str)


def test_every_supplier_string_finds_its_supplier(spark):
    rows = driver.entry(spark).select("affiliate", "institute_name").distinct().collect()
    assert rows and all(r.affiliate.split(",")[0] == r.institute_name for r in rows)
