"""Every registered query against its SQL equivalent on whole test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from starmill.workload.oracles import ORACLES
from starmill.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return connection


def _by_name(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    picked = (tuple(row[i] for i in order) for row in rows)
    return sorted(picked, key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = driver.queries()[name](spark, SF_DIR)
    cursor = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    got = _by_name(df.columns, df.collect())
    assert got and got == _by_name(columns, cursor.fetchall())


def test_entry_is_the_published_fact(spark):
    df = driver.entry(spark)
    assert df.columns[:5] == ["date_id", "transaction_date", "transaction_ts", "transaction_id", "seq_no"]
    assert df.limit(1).count() == 1
