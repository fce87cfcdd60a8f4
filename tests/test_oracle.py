"""Every registered query against its SQL twin in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from helpers import ordered, rows
from retailtide.plans.registry import all_oracles, all_queries

QUERIES = all_queries()
ORACLE = all_oracles()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in os.listdir(sf_dir):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{name}'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    frame = QUERIES[name](spark, sf_dir)
    twin = duck.sql(ORACLE[name])
    names = sorted(frame.columns)
    assert names == sorted(twin.columns)
    expected = twin.project(", ".join(f'"{n}"' for n in names)).fetchall()
    assert rows(frame) == ordered(expected)
    assert len(expected) > 0


def test_entry(spark):
    frame = entry_module.entry(spark)
    assert frame.columns == ["log_hour", "visitors"]
    assert frame.count() > 0
