"""Every registered query against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from weftline.plans import oracles
from weftline.plans import queries as registered

FOLDER = "/root/testdata/sf0.001"
# Those of the corpus subpackage are tested in its own folder.
QUERIES, SQL = registered.queries(), oracles.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6) + 0.0)
    return repr(value)


def test_flagship(spark):
    assert entry.entry(spark).count() == 10


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, capsys, name):
    df = QUERIES[name](spark, FOLDER)
    df.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    columns = sorted(df.columns)
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = [dict(zip(names, row, strict=True)) for row in result.fetchall()]
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    assert got == sorted([plain(r[c]) for c in columns] for r in expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
