"""Queries of this subpackage that SQL can express, against DuckDB on the whole tables."""

import duckdb
import pytest
from helpers import ordered, rows

from retailtide.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(name, spark, sf_dir):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = QUERIES[name](spark, sf_dir)
    twin = con.sql(ORACLE[name])
    names = sorted(frame.columns)
    assert names == sorted(twin.columns)
    expected = twin.project(", ".join(f'"{n}"' for n in names)).fetchall()
    assert rows(frame) == ordered(expected) and expected
