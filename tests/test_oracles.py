"""Every registered query against its SQL in another engine, over whole tables."""

import os

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry
from colonnade.plans.oracles import ORACLES
from colonnade.plans.queries import QUERIES

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    expected = duck.execute(entry.oracle_sql()[name])
    header = [d[0] for d in expected.description]
    assert sorted(header) == columns
    positions = [header.index(c) for c in columns]
    want = sorted([repr([row[i] for i in positions]) for row in expected.fetchall()])
    got = sorted([repr(list(row)) for row in result.select(*columns).collect()])
    assert got == want
    assert got


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["row_key", "family", "qualifier", "value"]
    assert result.count() > 0


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_results_do_not_depend_on_the_time_zone(spark, duck, conf, zone):
    conf(spark__sql__session__timeZone=zone)
    for name in ("resolve_latest", "key_time"):
        got = sorted(repr(sorted(r.asDict().items())) for r in entry.queries()[name](spark, SF_DIR).collect())
        rows = duck.execute(entry.oracle_sql()[name])
        header = [d[0] for d in rows.description]
        want = sorted(repr(sorted(zip(header, row))) for row in rows.fetchall())
        assert got == want
