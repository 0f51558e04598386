"""Every registered query against its SQL on the smallest test tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as contract
from workload import oracle
from workload import queries as catalogue

SF = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not SF.exists(), reason="test tables are not here")
QUERIES, SQL = catalogue.registered(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) - set(SQL) == {
        "gbt_fit", "scenario_grid", "aspect_model", "arimax_series", "arimax_forecasts",
    }


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    got = ordered(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    assert got
    if name not in SQL:
        return
    result = duck.sql(SQL[name])
    assert sorted(result.columns) == columns
    places = [result.columns.index(c) for c in columns]
    want = ordered(tuple(r[i] for i in places) for r in result.fetchall())
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        for x, y in zip(g, w, strict=True):
            same = x == y or (isinstance(x, float) and math.isclose(x, y, abs_tol=1e-9))
            assert same, (g, w)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["date", "with_ratio", "was_ratio", "p_win"] and df.count() > 0
