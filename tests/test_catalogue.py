"""Every query against the same query in SQL."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import check  # noqa: E402
from sonomere.plans import catalogue, oracles, timelines  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES = {**catalogue.QUERIES, **timelines.QUERIES}
ORACLES = {**oracles.ORACLES, **timelines.ORACLES}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in check.TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    result = QUERIES[name](spark, FOLDER)
    wanted = db.sql(ORACLES[name])
    assert not check.type_differences(result, wanted)
    assert check.compare(result.toPandas(), wanted.df()) == "ok"
