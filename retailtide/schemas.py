"""Record types of the topics and of the wide tables.

Times are kept as real ``timestamp``/``date`` columns and formatted only at the
output edge. ``ts`` is the arrival stamp in epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _record(*names: str, **kinds: T.DataType) -> T.StructType:
    """A record of these fields, texts unless ``kinds`` says otherwise."""
    return T.StructType([T.StructField(name, kinds.get(name, T.StringType())) for name in names])


# The fields of each record, in its order.
STARTUP = _record("mid", "uid", "appid", "area", "os", "ch", "type", "vs", "ts", ts=T.LongType())

EVENT = _record(
    "mid", "uid", "appid", "area", "os", "ch", "type", "evid", "pgid", "npgid", "itemid", "ts", ts=T.LongType()
)

ORDER = _record(
    "id",
    "province_id",
    "consignee",
    "order_comment",
    "consignee_tel",
    "order_status",
    "payment_way",
    "user_id",
    "img_url",
    "total_amount",
    "expire_time",
    "delivery_address",
    "create_time",
    "operate_time",
    "tracking_no",
    "parent_order_id",
    "out_trade_no",
    "trade_body",
    total_amount=T.DoubleType(),
)

ORDER_DETAIL = _record("id", "order_id", "sku_name", "sku_id", "order_price", "img_url", "sku_num")

USER = _record("id", "login_name", "user_level", "birthday", "gender")

# One committed row change of the shop database. ``rows`` holds the image after
# the change, one list of columns per row.
CHANGE = _record(
    "entry_type", "table", "op", "rows", rows=T.ArrayType(T.ArrayType(_record("name", "value")))
)

# Logical topic -> record type. Physical topic names are an argument of the
# source and the sink, so that one cluster can hold several deployments.
TOPICS: dict[str, T.StructType] = {
    "startup": STARTUP,
    "event": EVENT,
    "order": ORDER,
    "order_detail": ORDER_DETAIL,
    "user_info": USER,
}

# Where the ingest jobs send raw texts that they cannot read.
BROKEN_TOPIC = "broken"

# Stored columns of the visit table, in order.
VISIT_COLUMNS = ["mid", "uid", "appid", "area", "os", "ch", "type", "vs", "log_date", "log_hour", "ts"]

# Stored columns of the wide sale table, in order.
SALE_COLUMNS = [
    "order_detail_id",
    "order_id",
    "order_status",
    "create_time",
    "user_id",
    "sku_id",
    "user_gender",
    "user_age",
    "user_level",
    "sku_price",
    "sku_name",
    "dt",
]
