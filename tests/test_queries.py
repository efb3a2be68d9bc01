"""Every registered query against its SQL in another engine, on the smallest sample."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from gridwarden.plans.oracles import all_oracles
from gridwarden.plans.queries import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def oracle(sample_dir):
    connection = duckdb.connect()
    for path in Path(sample_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sample_dir, oracle, name):
    df = QUERIES[name](spark, sample_dir)
    got = sorted(repr([plain(r[c]) for c in sorted(df.columns)]) for r in df.collect())
    cursor = oracle.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    positions = [names.index(c) for c in sorted(names)]
    expected = sorted(repr([plain(r[p]) for p in positions]) for r in cursor.fetchall())
    assert got == expected and got


def test_entry(spark, sample_dir):
    assert entry_points.entry(spark).columns == ["week_start", "rank", "gateway_id", "score", "reason"]
