"""The long-running jobs. Each is its own query with its own checkpoint."""

from .alerts import AlertTable, alert_stream, alert_table
from .ingest import change_stream, log_archive_stream, log_route_stream
from .jobs import (
    DeviceTable,
    device_table,
    order_stream,
    order_table,
    sale_stream,
    sale_table,
    user_stream,
    user_table,
    users_in,
    visit_stream,
    visit_table,
)
from .run import drain, drain_each, every, follow

__all__ = [
    "AlertTable",
    "DeviceTable",
    "alert_stream",
    "alert_table",
    "change_stream",
    "device_table",
    "drain",
    "drain_each",
    "every",
    "follow",
    "log_archive_stream",
    "log_route_stream",
    "order_stream",
    "order_table",
    "sale_stream",
    "sale_table",
    "user_stream",
    "user_table",
    "users_in",
    "visit_stream",
    "visit_table",
]
