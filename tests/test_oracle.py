"""Every registered query against its SQL, value by value."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(contract.hourly_queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{file}'")
    yield con
    con.close()


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is not None, value) for value in row])


def test_every_query_has_sql():
    assert contract.hourly_queries().keys() == contract.hourly_sql().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({contract.oracle_sql()[name]})")
    types = [str(column[1]).upper() for column in expected.description]
    expected = in_order(expected.fetchall())
    actual = in_order([tuple(row) for row in df.select(*columns).collect()])
    assert len(actual) == len(expected) > 0
    assert actual == expected
    spark_types = [dict(df.dtypes)[name] for name in columns]
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER"}
    assert types == [names[each] for each in spark_types]


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 15
    assert df.count() == 25 * 721
