"""Sale line and report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import matches_all
from ..operators import report, sales, search
from ..operators.orders import enrich_orders
from ..schemas import SALE_COLUMNS
from ..session import stored
from .entities import AS_OF, lines_of, order_detail, order_info, orders_of, table, user_info, without_debt
from .orders import DETAILS_SQL, KNOWN_SQL, ORDERS_SQL

DAY = "1998-05-07"
KEYWORD = "red"
PAGE, PAGE_SIZE = 2, 3
DEEP_PAGE, DEEP_SIZE = 2_500, 8
INDEX_DAY, INDEX_KEYWORD = "1997-01-15", "plate red"


def _details(spark: SparkSession, sf_dir: str, day: str | None = None, keyword: str | None = None) -> DataFrame:
    """Order details; with ``keyword`` those of products whose name has all its words."""
    parts, lines = table(spark, sf_dir, "part"), lines_of(spark, sf_dir, day)
    if keyword is not None:
        # names belong to products: few texts are looked at, and few lines go on
        parts = parts.filter(matches_all(F.col("p_name"), keyword))
        lines = lines.join(parts.select(F.col("p_partkey").alias("l_partkey")), "l_partkey", "left_semi")
    return order_detail(lines, parts)


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_info(without_debt(table(spark, sf_dir, "customer")))


def _wide(spark: SparkSession, sf_dir: str, day: str | None = None, keyword: str | None = None) -> DataFrame:
    """The wide table; with ``day`` only that day's orders are read, with ``keyword`` only its products' lines.

    An order has one creation day, so cutting the order scan to a day gives
    exactly that day's lines.
    """
    orders = enrich_orders(order_info(orders_of(spark, sf_dir, day)))
    details, users = _details(spark, sf_dir, day, keyword), _users(spark, sf_dir)
    return sales.sale_lines(orders, details, users, AS_OF, columns=SALE_COLUMNS)


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(spark, sf_dir, DAY, KEYWORD).filter(F.col("dt") == DAY)


def _index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All wide lines, stored, and the index over their words."""
    lines = stored(_wide(spark, sf_dir), "lines")
    return lines, search.stored_index(lines)


def order_detail_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = order_info(table(spark, sf_dir, "orders")).select("id", "order_status", "user_id")
    details = _details(spark, sf_dir).select("id", "order_id", "sku_id", "order_price")
    return sales.details_with_orders_full(details, orders)


def sale_interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = enrich_orders(order_info(table(spark, sf_dir, "orders")))
    met = sales.merge_order_and_detail(orders, _details(spark, sf_dir))
    gap = F.unix_seconds("detail_ts") - F.unix_seconds("order_ts")
    return met.select("order_detail_id", "order_id", "sku_price", gap.alias("gap_seconds"))


def sale_user_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = order_info(table(spark, sf_dir, "orders")).select(
        F.col("id").alias("order_id"), "user_id"
    )
    wide = sales.with_user(orders, _users(spark, sf_dir), AS_OF)
    return wide.select("order_id", "user_id", "user_gender", "user_age", "user_level")


def sale_detail_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(spark, sf_dir)


def sale_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(spark, sf_dir)


def sale_search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.hit_total(_hits(spark, sf_dir))


def sale_search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.page(_hits(spark, sf_dir), PAGE, PAGE_SIZE)


def sale_search_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword of several words, by the index; no text is looked at."""
    lines, index = _index(spark, sf_dir)
    return search.indexed(lines, index, INDEX_DAY, INDEX_KEYWORD)


def sale_search_deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page far down, over the lines of all days."""
    return report.deep_page(_wide(spark, sf_dir), DEEP_PAGE, DEEP_SIZE)


def gender_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.gender_terms(_wide(spark, sf_dir, DAY))


def age_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.age_terms(_wide(spark, sf_dir))


def gender_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.gender_share(_hits(spark, sf_dir))


def age_band_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.age_band_share(_hits(spark, sf_dir))


def sale_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.stat_rows(_wide(spark, sf_dir))


def sale_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole answer, its lists as text."""
    answer = report.report(stored(_hits(spark, sf_dir), "hits"), 1, PAGE_SIZE)
    options = F.flatten(F.col("stat.options"))
    shown = F.transform(
        options, lambda o: F.concat(o["name"], F.lit("="), F.format_number(o["value"], 1))
    )
    return answer.select(
        "total",
        F.array_join(F.col("stat.title"), ",").alias("titles"),
        F.array_join(shown, ",").alias("options"),
        F.array_join(F.col("detail.order_detail_id"), ",").alias("detail_ids"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        order_detail_full,
        sale_interval_join,
        sale_user_left,
        sale_detail_wide,
        sale_search,
        sale_search_total,
        sale_search_page,
        sale_search_index,
        sale_search_deep_page,
        gender_terms,
        age_terms,
        gender_share,
        age_band_share,
        sale_stats,
        sale_report,
    )
}

WIDE_SQL = f"""{ORDERS_SQL}, {DETAILS_SQL}, {KNOWN_SQL},
met AS (
  SELECT d.id AS order_detail_id, d.order_id, o.order_status, o.create_time,
         o.create_date AS dt, o.user_id, d.sku_id, d.sku_name, d.order_price::DOUBLE AS sku_price,
         o.order_s, d.detail_s
  FROM det d JOIN ord o ON o.id = d.order_id
  WHERE abs(d.detail_s - o.order_s) <= 3600
),
lines AS (
  SELECT * FROM met
  QUALIFY row_number() OVER (PARTITION BY order_detail_id
    ORDER BY greatest(order_s, detail_s) DESC, order_s DESC, detail_s DESC, sku_price DESC,
             order_status DESC, create_time DESC) = 1
),
wide AS (
  SELECT order_detail_id, order_id, order_status, create_time, user_id, sku_id,
         gender AS user_gender, coalesce(age, 0)::INTEGER AS user_age, user_level, sku_price,
         sku_name, dt
  FROM lines LEFT JOIN usr ON usr.id = lines.user_id
),
hits AS (
  SELECT * FROM wide
  WHERE dt = '{DAY}' AND list_contains(regexp_extract_all(lower(sku_name), '[a-z0-9]+'), '{KEYWORD}')
)"""


def _percent(test: str) -> str:
    return (
        f"CASE WHEN count(*) = 0 THEN 0.0::DOUBLE ELSE "
        f"floor(count(*) FILTER ({test}) * 1000::DOUBLE / count(*) + 0.5::DOUBLE) / 10::DOUBLE END"
    )


_SHARES = {
    "M": _percent("user_gender = 'M'"),
    "F": _percent("user_gender = 'F'"),
    "under_20": _percent("user_age < 20"),
    "from_20_to_30": _percent("user_age BETWEEN 20 AND 30"),
    "over_30": _percent("user_age > 30"),
}
_TITLES = [
    ("性别占比", "男", "M"),
    ("性别占比", "女", "F"),
    ("年龄段占比", "20岁以下", "under_20"),
    ("年龄段占比", "20岁到30岁", "from_20_to_30"),
    ("年龄段占比", "30岁以上", "over_30"),
]


def _named(*keys: str) -> str:
    return ", ".join(f"{_SHARES[key]} AS {key}" for key in keys)


ORACLE = {
    "order_detail_full": f"""
WITH {ORDERS_SQL}, {DETAILS_SQL}
SELECT coalesce(d.order_id, o.id) AS order_id, d.id AS order_detail_id, d.sku_id,
       d.order_price::VARCHAR AS order_price, o.order_status, o.user_id
FROM det d FULL OUTER JOIN ord o ON o.id = d.order_id""",
    "sale_interval_join": f"""
WITH {WIDE_SQL}
SELECT order_detail_id, order_id, sku_price, detail_s - order_s AS gap_seconds FROM met""",
    "sale_user_left": f"""
WITH {ORDERS_SQL}, {KNOWN_SQL}
SELECT o.id AS order_id, o.user_id, gender AS user_gender, coalesce(age, 0)::INTEGER AS user_age,
       user_level
FROM ord o LEFT JOIN usr ON usr.id = o.user_id""",
    "sale_detail_wide": f"WITH {WIDE_SQL} SELECT * FROM wide",
    "sale_search": f"WITH {WIDE_SQL} SELECT * FROM hits",
    "sale_search_total": f"WITH {WIDE_SQL} SELECT count(*) AS total FROM hits",
    "sale_search_page": f"""
WITH {WIDE_SQL}
SELECT * FROM hits ORDER BY order_detail_id LIMIT {PAGE_SIZE} OFFSET {(PAGE - 1) * PAGE_SIZE}""",
    "sale_search_index": f"""
WITH {WIDE_SQL}
SELECT * FROM wide
WHERE dt = '{INDEX_DAY}' AND list_has_all(regexp_extract_all(lower(sku_name), '[a-z0-9]+'), {INDEX_KEYWORD.split()})""",
    "sale_search_deep_page": f"""
WITH {WIDE_SQL}
SELECT * FROM wide ORDER BY order_detail_id LIMIT {DEEP_SIZE} OFFSET {(DEEP_PAGE - 1) * DEEP_SIZE}""",
    "gender_terms": f"""
WITH {WIDE_SQL}
SELECT user_gender, count(*) AS hits FROM wide WHERE dt = '{DAY}' AND user_gender IS NOT NULL
GROUP BY user_gender ORDER BY hits DESC, user_gender LIMIT 2""",
    "age_terms": f"""
WITH {WIDE_SQL}
SELECT user_age, count(*) AS hits FROM wide GROUP BY user_age
ORDER BY hits DESC, user_age LIMIT 100""",
    "gender_share": f"WITH {WIDE_SQL} SELECT count(*) AS total, {_named('M', 'F')} FROM hits",
    "age_band_share": f"""
WITH {WIDE_SQL}
SELECT count(*) AS total, {_named('under_20', 'from_20_to_30', 'over_30')} FROM hits""",
    "sale_stats": f"WITH {WIDE_SQL} "
    + " UNION ALL ".join(
        f"SELECT count(*) AS total, '{title}' AS title, '{name}' AS name, {_SHARES[key]} AS value "
        "FROM wide"
        for title, name, key in _TITLES
    ),
    "sale_report": f"""
WITH {WIDE_SQL}
SELECT count(*) AS total, '性别占比,年龄段占比' AS titles,
       concat_ws(',', {", ".join(f"'{name}=' || printf('%.1f', {_SHARES[key]})" for _, name, key in _TITLES)})
         AS options,
       (SELECT coalesce(string_agg(order_detail_id, ',' ORDER BY order_detail_id), '') FROM
          (SELECT order_detail_id FROM hits ORDER BY order_detail_id LIMIT {PAGE_SIZE}))
         AS detail_ids
FROM hits""",
}
