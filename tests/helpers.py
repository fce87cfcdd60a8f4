"""Small helpers shared by the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows(frame: DataFrame) -> list[tuple]:
    """Rows as tuples, columns by name, in a fixed order."""
    names = sorted(frame.columns)
    found = [tuple(row) for row in frame.select(*names).collect()]
    return ordered(found)


def ordered(found: list[tuple]) -> list[tuple]:
    return sorted(found, key=lambda row: tuple((value is None, str(value)) for value in row))


def plan(frame: DataFrame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
