"""Change records of the shop database to topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import last_values, no_repeats
from ..schemas import BROKEN_TOPIC
from .logs import dead_letter

# (table, operation) -> topic. Everything else is dropped: order updates and all
# deletes are not forwarded. Pass another table to forward more.
ROUTES: dict[tuple[str, str], str] = {
    ("order_info", "INSERT"): "order",
    ("order_detail", "INSERT"): "order_detail",
    ("user_info", "INSERT"): "user_info",
    ("user_info", "UPDATE"): "user_info",
}


def _topic(routes: dict[tuple[str, str], str]) -> Column:
    """The topic of a change record; null where it is not forwarded."""
    kinds = [
        F.when((F.col("table") == table) & (F.col("op") == op), F.lit(topic))
        for (table, op), topic in routes.items()
    ]
    return F.when(F.col("entry_type") == "ROWDATA", F.coalesce(*kinds))


def route_changes(changes: DataFrame, routes: dict[tuple[str, str], str] = ROUTES) -> DataFrame:
    """(topic, table, op, columns): one record per changed row of a routed kind."""
    routed = changes.withColumn("topic", _topic(routes)).filter(F.col("topic").isNotNull())
    return routed.select("topic", "table", "op", F.explode("rows").alias("columns"))


def _flat() -> Column:
    """The columns of a row as flat JSON, all values texts.

    Of a repeated column the last value stays; one without a name is left out.
    """
    columns = F.col("columns")
    named = F.transform(columns, lambda c: F.struct(c["name"].alias("key"), c["value"].alias("value")))
    as_map = F.when(no_repeats(columns["name"]), F.map_from_arrays(columns["name"], columns["value"]))
    return F.to_json(as_map.otherwise(last_values(F.filter(named, lambda c: c["key"].isNotNull()))))


def flatten_rows(routed: DataFrame) -> DataFrame:
    """(topic, value): the row after the change as flat JSON, see :func:`_flat`."""
    return routed.select("topic", _flat().alias("value"))


def flatten_or_reject(
    changes: DataFrame, reason: Column, routes: dict[tuple[str, str], str] = ROUTES
) -> DataFrame:
    """:func:`flatten_rows` of :func:`route_changes`, with the records that have a ``reason`` as dead letters.

    ``changes`` has the raw ``text`` of each record. One pass gives both: a rejected record is
    routed to ``BROKEN_TOPIC`` as if it had one row. A missing row gives no record.
    """
    no_row = F.array(F.lit(None).cast(changes.schema["rows"].dataType.elementType))
    bad = F.col("reason").isNotNull()
    topic = F.when(bad, F.lit(BROKEN_TOPIC)).otherwise(_topic(routes))
    marked = changes.withColumn("reason", reason).withColumn("topic", topic).filter(F.col("topic").isNotNull())
    rows = marked.select("topic", "reason", "text", F.explode(F.when(bad, no_row).otherwise(F.col("rows"))).alias("columns"))
    value = F.when(bad, dead_letter("raw_change", F.col("reason"), F.col("text"))).otherwise(_flat())
    return rows.select("topic", value.alias("value")).filter(F.col("value").isNotNull())
