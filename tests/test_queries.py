"""Every registered query against the same query in an independent SQL engine."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tickloom.plans.expected_sql import EXPECTED_SQL
from tickloom.plans.queries import QUERIES

TIMES = ("datetime64[us]", "datetime64[ns]")


@pytest.fixture(scope="module")
def engine(sf_dir):
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def comparable(rows):
    return sorted((tuple(str(v) for v in row) for row in rows))


def test_every_query_has_expected_sql():
    assert set(QUERIES) == set(EXPECTED_SQL)
    assert set(QUERIES) <= set(contract.queries())
    assert set(EXPECTED_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, engine, sf_dir, name):
    actual = contract.queries()[name](spark, sf_dir)
    expected = engine.sql(contract.oracle_sql()[name])
    columns = sorted(actual.columns)
    assert columns == sorted(expected.columns)
    listed = ", ".join(f'"{c}"' for c in columns)
    quoted = [f"`{c}`" for c in columns]
    assert comparable(actual.select(*quoted).collect()) == comparable(expected.select(listed).fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
