"""Every registered query against its SQL, over the whole sf0.001 tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from entry.oracles import ORACLES
from entry.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="benchmark tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(str(tuple(_cell(r[i]) for i in order)) for r in data)


def test_every_query_has_an_oracle():
    """The optional part registers queries beyond SQL, which its own tests cover."""
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_flagship(spark):
    assert contract.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    want = duck.sql(ORACLES[name])
    assert _table(df.columns, [tuple(r) for r in df.collect()]) == _table(want.columns, want.fetchall())
