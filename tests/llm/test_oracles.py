"""The queries that SQL can express against DuckDB."""

import zlib

import duckdb
import pytest

import check
from sonomere.llm import oracles, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "pages"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", oracles.ORACLES)
def test_query(spark, db, name):
    result = queries.QUERIES[name](spark, SF)
    wanted = db.sql(oracles.ORACLES[name])
    assert not check.type_differences(result, wanted)
    assert check.compare(result.toPandas(), wanted.df()) == "ok"


def test_checksum(db):
    for text in ("0", "7", "-12", "123456789"):
        sql = oracles.CRC32.format(text=f"'{text}'")
        assert db.sql(f"SELECT {sql}").fetchall() == [(zlib.crc32(text.encode()),)]
