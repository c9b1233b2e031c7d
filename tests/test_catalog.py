"""Every catalog query against its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from scrublens.plans.catalog import QUERIES
from scrublens.plans.oracle import SQL
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_like_duckdb(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    names = sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*names).collect())))
    quoted = ", ".join(f'"{n}"' for n in names)
    expected = duck.execute(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()
    assert got == sorted(map(repr, expected))
    assert got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
