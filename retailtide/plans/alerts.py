"""Alert queries.

The given events are minutes apart, so most run the rule with a window of hours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import alerts
from ..session import stored
from .entities import event_info, table

HOUR = 3600
SIZE, SLIDE = 6 * HOUR, HOUR
DEDUP_SIZE, DEDUP_SLIDE = 2 * HOUR, 30


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_info(table(spark, sf_dir, "events"))


def shown(rows: DataFrame) -> DataFrame:
    """Times as text, for the edge."""
    times = [name for name in ("window_start", "window_end") if name in rows.columns]
    return rows.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss") for n in times})


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.coupon_alerts(_events(spark, sf_dir), SIZE, SLIDE)


def device_event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(alerts.device_profiles(_events(spark, sf_dir), SIZE, SLIDE))


def device_event_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(alerts.device_members(_events(spark, sf_dir), SIZE, SLIDE))


def coupon_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_alerts(spark, sf_dir))


def coupon_alert_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alerts.coupon_alerts(_events(spark, sf_dir), DEDUP_SIZE, DEDUP_SLIDE)
    return shown(alerts.latest_alerts(found))


def coupon_alert_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, a row per member."""
    found = stored(_alerts(spark, sf_dir), "alerts")
    return alerts.alert_documents(_events(spark, sf_dir), found, SIZE, SLIDE)


def coupon_alert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of each alert, in their order."""
    found = stored(_alerts(spark, sf_dir), "alerts")
    return alerts.alert_events(_events(spark, sf_dir), found, SIZE, SLIDE)


QUERIES = {
    f.__name__: f
    for f in (
        device_event_profile,
        device_event_members,
        coupon_alert,
        coupon_alert_dedup,
        coupon_alert_document,
        coupon_alert_events,
    )
}


def windows_sql(size: int, slide: int) -> str:
    return f"""
ev AS (
  SELECT (user_id // 15)::VARCHAR AS mid, user_id::VARCHAR AS uid,
         CASE event_type WHEN 'view' THEN 'coupon' WHEN 'purchase' THEN 'clickItem'
                         ELSE event_type END AS evid,
         json_extract_string(props, '$.k') AS itemid, ts, event_id
  FROM events
),
win AS (
  SELECT time_bucket(INTERVAL '{slide} seconds', ts) - k * INTERVAL '{slide} seconds'
           AS window_start, ev.*
  FROM ev, range({size // slide}) r(k)
),
profile AS (
  SELECT window_start, window_start + INTERVAL '{size} seconds' AS window_end, mid,
         count(DISTINCT CASE WHEN evid = 'coupon' THEN uid END) AS coupon_uids,
         count(DISTINCT CASE WHEN evid = 'coupon' THEN itemid END) AS coupon_items,
         count(*) AS events, bool_or(evid = 'clickItem') AS clicked
  FROM win GROUP BY window_start, mid
),
alert AS (
  SELECT mid || '_' || (epoch_ms(window_end) // 60000)::VARCHAR AS alert_id,
         epoch_ms(window_end) AS ts, * EXCLUDE (clicked)
  FROM profile WHERE coupon_uids >= 3 AND NOT clicked
)"""


_START = "strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start"
_END = "strftime(window_end, '%Y-%m-%d %H:%M:%S') AS window_end"
ALERT_COLUMNS = f"alert_id, mid, {_START}, {_END}, coupon_uids, coupon_items, events, ts"
_WIN_END = f"strftime(window_start + INTERVAL '{SIZE} seconds', '%Y-%m-%d %H:%M:%S') AS window_end"

ORACLE = {
    "device_event_profile": f"""
WITH {windows_sql(SIZE, SLIDE)}
SELECT {_START}, {_END}, mid, coupon_uids, coupon_items, events, clicked FROM profile""",
    "device_event_members": f"""
WITH {windows_sql(SIZE, SLIDE)}
SELECT {_START}, {_WIN_END}, mid, 'event' AS kind, evid AS value, count(*) AS n
FROM win GROUP BY ALL
UNION ALL
SELECT {_START}, {_WIN_END}, mid, 'uid' AS kind, uid AS value, count(*) AS n
FROM win WHERE evid = 'coupon' AND uid IS NOT NULL GROUP BY ALL
UNION ALL
SELECT {_START}, {_WIN_END}, mid, 'item' AS kind, itemid AS value, count(*) AS n
FROM win WHERE evid = 'coupon' AND itemid IS NOT NULL GROUP BY ALL""",
    "coupon_alert": f"WITH {windows_sql(SIZE, SLIDE)} SELECT {ALERT_COLUMNS} FROM alert",
    "coupon_alert_dedup": f"""
WITH {windows_sql(DEDUP_SIZE, DEDUP_SLIDE)}, latest AS (
  SELECT * FROM alert
  QUALIFY row_number() OVER (PARTITION BY alert_id ORDER BY window_end DESC) = 1
)
SELECT {ALERT_COLUMNS} FROM latest""",
    "coupon_alert_events": f"""
WITH {windows_sql(SIZE, SLIDE)}
SELECT a.alert_id, a.mid, a.ts, w.evid, w.event_id,
       row_number() OVER (PARTITION BY a.mid, a.window_start ORDER BY w.ts, w.event_id) AS position
FROM alert a JOIN win w ON w.window_start = a.window_start AND w.mid = a.mid""",
    "coupon_alert_document": f"""
WITH {windows_sql(SIZE, SLIDE)}, held AS (
  SELECT a.alert_id, a.mid, a.ts, w.evid, w.uid, w.itemid
  FROM alert a JOIN win w ON w.window_start = a.window_start AND w.mid = a.mid
)
SELECT alert_id, mid, ts, 'event' AS kind, evid AS value, count(*) AS n FROM held GROUP BY ALL
UNION ALL
SELECT alert_id, mid, ts, 'uid' AS kind, uid AS value, count(*) AS n FROM held
WHERE evid = 'coupon' AND uid IS NOT NULL GROUP BY ALL
UNION ALL
SELECT alert_id, mid, ts, 'item' AS kind, itemid AS value, count(*) AS n FROM held
WHERE evid = 'coupon' AND itemid IS NOT NULL GROUP BY ALL""",
}
