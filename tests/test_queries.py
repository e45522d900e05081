"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("nation", "customer", "part", "orders", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    cursor = duck.execute(ORACLES[name])
    positions = {d[0]: i for i, d in enumerate(cursor.description)}
    assert sorted(positions) == columns
    expected = [tuple(row[positions[c]] for c in columns) for row in cursor.fetchall()]
    assert len(got) > 0
    assert sorted(got, key=repr) == sorted(expected, key=repr)
