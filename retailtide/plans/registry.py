"""All queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    from . import alerts, ingest, orders, sales, streams, visits

    found: dict[str, Query] = {}
    for module in (visits, orders, ingest, sales, alerts, streams):
        found.update(module.QUERIES)
    return found


def all_oracles() -> dict[str, str]:
    from . import alerts, ingest, orders, sales, streams, visits

    found: dict[str, str] = {}
    for module in (visits, orders, ingest, sales, alerts, streams):
        found.update(module.ORACLE)
    return found
