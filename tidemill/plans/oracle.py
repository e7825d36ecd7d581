"""The queries of the registry in DuckDB SQL, for checking results."""

from __future__ import annotations

from tidemill.plans.registry import (
    AS_OF, DAU_DAY, DAY_KEYWORD, DEEP_PAGE, DENSE, KEYWORD, ORDER_DAY, PAGE_SIZE, STAMP, WIDE,
)
from tidemill.schemas import (
    AGE_COUNT_NAMES, AGE_SHARE_NAMES, AGE_TITLE, GENDER_NAMES, GENDER_TITLE, KPI_NAMES,
    SALE_DETAIL,
)

VIEWS = """
WITH startup_log AS (
  SELECT concat('mid_', user_id) AS mid, cast(user_id AS varchar) AS uid, 'shop' AS appid,
         concat('area_', user_id % 25) AS area,
         CASE WHEN user_id % 10 < 3 THEN 'ios' ELSE 'android' END AS os,
         CASE WHEN user_id % 10 < 3 THEN 'appstore' ELSE concat('ch_', user_id % 7) END AS ch,
         'startup' AS type, concat('1.', event_id % 4, '.0') AS vs, epoch_us(ts) // 1000 AS ts,
         strftime(ts, '%Y-%m-%d') AS log_date, strftime(ts, '%H') AS log_hour
  FROM events WHERE event_type = 'signup'),
event_log AS (
  SELECT concat('mid_', user_id % 5) AS mid, cast(user_id AS varchar) AS uid, 'event' AS type,
         CASE event_type WHEN 'purchase' THEN 'coupon' WHEN 'view' THEN 'clickItem'
              WHEN 'click' THEN 'addCart' ELSE 'addComment' END AS evid,
         cast(event_id % 50 AS varchar) AS itemid, epoch_us(ts) // 1000 AS ts
  FROM events WHERE event_type <> 'signup'),
order_info AS (
  SELECT *, strftime(order_ts, '%Y-%m-%d %H:%M:%S') AS create_time,
         strftime(order_ts, '%Y-%m-%d') AS create_date, strftime(order_ts, '%H') AS create_hour
  FROM (
    SELECT cast(o_orderkey AS varchar) AS id, cast(c_nationkey AS varchar) AS province_id,
           concat('138', lpad(cast(o_custkey AS varchar), 8, '0')) AS consignee_tel,
           o_orderstatus AS order_status, cast(o_custkey AS varchar) AS user_id,
           o_totalprice AS total_amount,
           o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS order_ts
    FROM orders JOIN customer ON o_custkey = c_custkey)),
order_detail AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity AS int)) AS id,
         cast(l_orderkey AS varchar) AS order_id, p_name AS sku_name,
         cast(l_partkey AS varchar) AS sku_id, l_extendedprice AS sku_price,
         cast(cast(l_quantity AS int) AS varchar) AS sku_num,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400 + ((l_partkey % 151) - 60) * 60) AS detail_ts
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
user_info AS (
  SELECT cast(c_custkey AS varchar) AS id, c_name AS login_name, c_mktsegment AS user_level,
         strftime(DATE '1960-01-01' + cast((c_custkey * 7919) % 14000 AS int), '%Y-%m-%d') AS birthday,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer WHERE c_acctbal >= 0),
dau AS (
  SELECT * FROM startup_log
  QUALIFY row_number() OVER (PARTITION BY mid, log_date ORDER BY ts, uid, appid, area, os, ch, type, vs) = 1),
flagged AS (
  SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
                 THEN '1' ELSE '0' END AS if_first_order
  FROM order_info),
past_users AS (SELECT DISTINCT user_id FROM order_info WHERE create_time < '$ORDER_DAY$'),
sale_detail AS (
  SELECT d.id AS order_detail_id, o.id AS order_id, o.order_status, o.create_time, o.user_id, d.sku_id,
         u.gender AS user_gender,
         coalesce(cast((DATE '$AS_OF$' - cast(u.birthday AS date)) // 365 AS int), 0) AS user_age,
         u.user_level, d.sku_price, d.sku_name, o.create_date AS dt
  FROM order_detail d JOIN order_info o ON d.order_id = o.id
   AND d.detail_ts BETWEEN o.order_ts - INTERVAL 1 HOUR AND o.order_ts + INTERVAL 1 HOUR
  LEFT JOIN user_info u ON u.id = o.user_id),
hits AS (
  SELECT * FROM sale_detail
  WHERE list_has_all(regexp_split_to_array(lower(sku_name), '[^a-z0-9]+'), $KEYWORD$)),
day_hits AS (
  SELECT * FROM sale_detail
  WHERE dt = '$ORDER_DAY$'
    AND list_has_all(regexp_split_to_array(lower(sku_name), '[^a-z0-9]+'), $DAY_KEYWORD$))
"""


def _fill(sql: str) -> str:
    values = {
        "ORDER_DAY": ORDER_DAY, "DAU_DAY": DAU_DAY, "AS_OF": AS_OF,
        "KEYWORD": str(KEYWORD.split()), "DAY_KEYWORD": str(DAY_KEYWORD.split()),
        "STAMP": str(STAMP), "PAGE_SIZE": str(PAGE_SIZE), "DEEP_PAGE": str(DEEP_PAGE),
    }
    for name, value in values.items():
        sql = sql.replace(f"${name}$", value)
    return sql


def _windows(size: int, slide: int) -> str:
    """Every event in each of its windows, then grouped."""
    return f"""
, spread AS (
  SELECT mid, uid, evid, itemid,
         unnest(generate_series(
           ((ts // 1000 - {size}) // {slide}) * {slide} + {slide}, (ts // 1000 // {slide}) * {slide}, {slide})) AS s
  FROM event_log),
windowed AS (
  SELECT mid, s, s + {size} AS e,
         list_sort(list(DISTINCT uid) FILTER (evid = 'coupon')) AS uids,
         list_sort(list(DISTINCT itemid) FILTER (evid = 'coupon')) AS item_ids,
         list_sort(list(evid)) AS events, bool_or(evid = 'clickItem') AS clicked
  FROM spread GROUP BY mid, s),
alert AS (SELECT * FROM windowed WHERE len(uids) >= 3 AND NOT clicked)
"""


def _text(column: str) -> str:
    return f"coalesce(array_to_string({column}, ','), '') AS {column}"


def _at(column: str, name: str) -> str:
    return f"strftime(make_timestamp({column} * 1000000), '%Y-%m-%d %H:%M:%S') AS {name}"


LISTS = ", ".join(map(_text, ("uids", "item_ids", "events")))
ALERTS = f"SELECT mid, {_at('e', 'window_end')}, {LISTS} FROM alert"
PER_MINUTE = f"""
SELECT concat(mid, '_', e // 60) AS id, mid, {LISTS}, e * 1000 AS ts,
       strftime(make_timestamp(e * 1000000), '%Y-%m-%d') AS dt
FROM alert QUALIFY row_number() OVER (PARTITION BY mid, e // 60 ORDER BY e DESC) = 1"""

LATEST_USERS = """
SELECT id, login_name, CASE WHEN user_level IN ('BUILDING', 'MACHINERY') THEN concat(user_level, '+')
       ELSE user_level END AS user_level, birthday, gender
FROM user_info"""


def _pct(part: str, total: str = "count(*)") -> str:
    return (f"coalesce(floor(({part}) * 1000.0::double / nullif({total}, 0) + 0.5) / 10, 0.0::double)")


BANDS = ["user_age < 20", "user_age >= 20 AND user_age < 30", "user_age >= 30"]


def _shares(hits: str, title: str, names: list[str], conditions: list[str], where: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{title}' AS title, '{name}' AS name, "
        f"{_pct(f'count(*) FILTER ({condition})')} AS value FROM {hits} {where}"
        for name, condition in zip(names, conditions))


def _age_share(hits: str, where: str = "") -> str:
    return _shares(hits, AGE_TITLE, AGE_SHARE_NAMES, BANDS, where)


def _gender_share(hits: str) -> str:
    conditions = [f"user_gender = '{g}'" for g in GENDER_NAMES]
    return _shares(hits, GENDER_TITLE, list(GENDER_NAMES.values()), conditions)


def _demographics(hits: str) -> str:
    parts = [("age", n, c) for n, c in zip(AGE_COUNT_NAMES, BANDS)]
    parts += [("gender", n, f"user_gender = '{g}'") for g, n in GENDER_NAMES.items()]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS title, '{n}' AS name, count(*) FILTER ({c}) AS value FROM {hits}"
        for t, n, c in parts)


def _money(column: str = "total_amount") -> str:
    return f"cast(sum(cast({column} AS decimal(18,2))) AS double)"


def _kpis(day: str) -> str:
    return f"""
SELECT 'dau' AS id, '{KPI_NAMES["dau"]}' AS name, cast(count(*) AS double) AS value
FROM dau WHERE log_date = '{day}'
UNION ALL SELECT 'new_mid', '{KPI_NAMES["new_mid"]}', cast(count(*) AS double)
FROM (SELECT mid FROM dau GROUP BY mid HAVING min(log_date) = '{day}')
UNION ALL SELECT 'order_amount', '{KPI_NAMES["order_amount"]}', coalesce({_money()}, 0.0)
FROM order_info WHERE create_date = '{day}'"""


def _hours(table: str, day_column: str, hour_column: str, day: str, value: str, zero: str) -> str:
    def one(shift: int) -> str:
        return (f"(SELECT {value} FROM {table} WHERE {hour_column} = hour AND "
                f"{day_column} = strftime(DATE '{day}' - {shift}, '%Y-%m-%d'))")
    return f"""
SELECT hour, coalesce({one(1)}, {zero}) AS yesterday, coalesce({one(0)}, {zero}) AS today
FROM (SELECT lpad(cast(range AS varchar), 2, '0') AS hour FROM range(24))"""


def _hour_map(shift: int) -> str:
    return f"""
(SELECT '{{' || string_agg('"' || log_hour || '":' || n, ',' ORDER BY log_hour) || '}}'
 FROM (SELECT log_hour, count(*) AS n FROM dau
       WHERE log_date = strftime(DATE '$DAU_DAY$' - {shift}, '%Y-%m-%d') GROUP BY log_hour))"""


def _page(hits: str, size: str, offset: str) -> str:
    return f"SELECT * FROM {hits} ORDER BY order_detail_id LIMIT {size} OFFSET {offset}"


def _json(*columns: str) -> str:
    return "json_object(" + ", ".join(f"'{c}', {c}" for c in columns) + ")"


def _document(hits: str, size: int) -> str:
    def stat(title: str, names: list[str], conditions: list[str]) -> str:
        options = ", ".join(
            f"json_object('name', '{n}', 'value', (SELECT {_pct(f'count(*) FILTER ({c})')} FROM {hits}))"
            for n, c in zip(names, conditions))
        return f"json_object('title', '{title}', 'options', json_array({options}))"

    genders = [f"user_gender = '{g}'" for g in GENDER_NAMES]
    stats = ", ".join([
        stat(AGE_TITLE, AGE_SHARE_NAMES, BANDS), stat(GENDER_TITLE, list(GENDER_NAMES.values()), genders)])
    # the merge leaves out fields without a value
    rows = f"json_merge_patch('{{}}', {_json(*SALE_DETAIL.names)})"
    return f"""
SELECT cast(json_object(
  'stat', json_array({stats}), 'total', (SELECT count(*) FROM {hits}),
  'detail', (SELECT coalesce(to_json(list({rows} ORDER BY order_detail_id)), json_array())
             FROM (SELECT * FROM {hits} ORDER BY order_detail_id LIMIT {size}))) AS varchar) AS document"""


PAIR_COLUMNS = """o.id, o.user_id, o.create_time, d.id AS order_detail_id, d.order_id AS detail_order_id,
  d.sku_id"""
FLAGS = "SELECT id, user_id, create_time, if_first_order FROM flagged"
DAU_ROWS = "SELECT mid, uid, area, os, ch, vs, ts, log_date, log_hour FROM dau"
FACET_TERMS = """
SELECT {field} AS value, count(*) AS doc_count FROM hits WHERE {field} IS NOT NULL
GROUP BY {field} ORDER BY doc_count DESC, value LIMIT {size}"""

BODIES = {
    "log_date_hour": "SELECT mid, ts, log_date, log_hour FROM startup_log",
    "create_time_split": "SELECT id, create_time, create_date, create_hour FROM order_info",
    "mask_phone": """
SELECT id, concat(substr(consignee_tel, 1, 3), '****', substr(consignee_tel, 8)) AS consignee_tel
FROM order_info""",
    "age_years": """
SELECT id, birthday, cast((DATE '$AS_OF$' - cast(birthday AS date)) // 365 AS int) AS age FROM user_info""",
    "price_cast": "SELECT id, sku_price FROM order_detail",
    "yesterday_compact": """
SELECT id, strftime(cast(create_date AS date) - 1, '%Y-%m-%d') AS yesterday,
       replace(create_date, '-', '') AS compact FROM order_info""",
    "route_logs": """
SELECT 'startup' AS topic, mid, uid, type, '$STAMP$' AS ts FROM startup_log
UNION ALL SELECT 'event', mid, uid, type, '$STAMP$' FROM event_log""",
    "stamped_lines": """
SELECT 'startup' AS topic, cast(json_object(
    'mid', mid, 'type', type, 'n', cast(uid AS bigint), 'even', cast(uid AS bigint) % 2 = 0, 'quarter', cast(uid AS bigint) / 4 + 0.125,
    'place', json_object('area', area), 'next', json_array(cast(uid AS bigint), cast(uid AS bigint) + 1), 'ts', $STAMP$)
    AS varchar) AS value FROM startup_log""",
    "stream_bad_records": """
SELECT 'dau' AS job, 'startup_log' AS record, 'startup' AS topic, ts AS "offset",
       CASE WHEN ts % 5 = 0 THEN '{"mid":' END AS value,
       CASE WHEN ts % 5 = 0 THEN 'no JSON object' ELSE 'no value' END AS reason
FROM startup_log WHERE ts % 5 = 0 OR ts % 7 = 0""",
    "route_changes": f"""
SELECT 'user' AS topic, id AS key,
       cast({_json("id", "login_name", "user_level", "birthday", "gender")} AS varchar) AS value FROM user_info
UNION ALL SELECT 'user', id, cast({_json("id", "login_name", "user_level", "birthday", "gender")} AS varchar)
FROM (SELECT * REPLACE (concat(user_level, '+') AS user_level) FROM user_info
      WHERE user_level IN ('BUILDING', 'MACHINERY'))
UNION ALL SELECT 'order', id, cast({_json("id", "province_id", "consignee_tel", "order_status", "user_id",
                                         "total_amount", "create_time")} AS varchar)
FROM (SELECT * REPLACE (cast(total_amount AS varchar) AS total_amount) FROM order_info)
UNION ALL SELECT 'order_detail', id, cast({_json("id", "order_id", "sku_name", "sku_id", "order_price",
                                                "sku_num")} AS varchar)
FROM (SELECT *, cast(sku_price AS varchar) AS order_price FROM order_detail)""",
    "decode_orders": """
SELECT id, province_id, consignee_tel, order_status, user_id, total_amount, create_time FROM order_info""",
    "decode_logs": "SELECT mid, uid, evid, itemid, $STAMP$ AS ts FROM event_log",
    "dau_first": DAU_ROWS,
    "dau_drop_seen": """
SELECT mid, log_date, ts FROM startup_log s WHERE NOT EXISTS (
  SELECT 1 FROM dau WHERE dau.mid = s.mid AND dau.log_date = s.log_date AND dau.log_hour < '12')""",
    "dau_total": "SELECT count(*) AS total FROM dau WHERE log_date = '$DAU_DAY$'",
    "dau_hour": "SELECT log_hour, count(*) AS ct FROM dau WHERE log_date = '$DAU_DAY$' GROUP BY log_hour",
    "new_devices": """
SELECT log_date, count(*) AS new_devices FROM (SELECT mid, min(log_date) AS log_date FROM dau GROUP BY mid)
GROUP BY log_date""",
    "user_state_lookup": """
SELECT id, o.user_id, CASE WHEN p.user_id IS NULL THEN '0' ELSE '1' END AS if_ordered
FROM order_info o LEFT JOIN past_users p ON o.user_id = p.user_id""",
    "state_rows": """
SELECT user_id, '1' AS if_ordered FROM past_users
WHERE user_id IN (SELECT user_id FROM order_info WHERE create_date = '$ORDER_DAY$')""",
    "first_order_flag": FLAGS,
    "first_order_flag_known": """
SELECT id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY create_time, id) = 1
       AND user_id NOT IN (SELECT user_id FROM past_users) THEN '1' ELSE '0' END AS if_first_order
FROM order_info WHERE create_time >= '$ORDER_DAY$'""",
    "new_user_state": "SELECT user_id, if_first_order AS if_ordered FROM flagged WHERE if_first_order = '1'",
    "order_amount_total": f"""
SELECT coalesce({_money()}, 0.0) AS total_amount FROM order_info WHERE create_date = '$ORDER_DAY$'""",
    "order_amount_hour": f"""
SELECT create_hour, {_money()} AS total_amount FROM order_info WHERE create_date = '$ORDER_DAY$'
GROUP BY create_hour""",
    "province_sales": f"""
SELECT province_id, {_money()} AS total_amount, count(*) AS order_count FROM order_info GROUP BY province_id""",
    "order_detail_inner": f"SELECT {PAIR_COLUMNS} FROM order_info o JOIN order_detail d ON o.id = d.order_id",
    "order_detail_full": f"""
SELECT {PAIR_COLUMNS} FROM order_info o FULL OUTER JOIN order_detail d ON o.id = d.order_id""",
    "order_detail_interval": """
SELECT order_detail_id, order_id, user_id, sku_id, sku_price, dt FROM sale_detail""",
    "latest_users": LATEST_USERS,
    "sale_detail": "SELECT * FROM sale_detail",
    "product_sales": """
SELECT sku_name AS name, cast(sum(cast(sku_num AS bigint)) AS bigint) AS num FROM order_detail
WHERE order_id IN (SELECT id FROM order_info) GROUP BY sku_name""",
    "keyword_match": "SELECT order_detail_id, sku_name, dt FROM hits",
    "keyword_match_indexed": "SELECT order_detail_id, sku_name, dt FROM hits",
    "total_hits": "SELECT count(*) AS total FROM hits",
    "sale_page": _page("hits", "$PAGE_SIZE$", "0"),
    "sale_page_2": _page("hits", "$PAGE_SIZE$", "$PAGE_SIZE$"),
    "sale_page_deep": _page("sale_detail", "$PAGE_SIZE$", "($DEEP_PAGE$ - 1) * $PAGE_SIZE$"),
    "gender_terms": FACET_TERMS.format(field="user_gender", size=2),
    "age_terms": FACET_TERMS.format(field="user_age", size=100),
    "age_share": _age_share("hits"),
    "age_share_known": _age_share("hits", "WHERE user_gender IS NOT NULL"),
    "gender_share": _gender_share("hits"),
    "demographics": _demographics("hits"),
    "kpi_board": _kpis(DAU_DAY),
    "kpi_board_orders": _kpis(ORDER_DAY),
    "hour_compare_dau": _hours("dau", "log_date", "log_hour", DAU_DAY, "count(*)", "0"),
    "hour_compare_amount": _hours("order_info", "create_date", "create_hour", ORDER_DAY, _money(), "0.0"),
    "hour_map_dau": f"SELECT {_hour_map(0)} AS today, {_hour_map(1)} AS yesterday",
    "sale_search_total": "SELECT count(*) AS total FROM day_hits",
    "sale_search_page": _page("day_hits", "5", "0"),
    "sale_search_indexed": _page("day_hits", "5", "0"),
    "sale_search_age": _age_share("day_hits"),
    "sale_search_gender": _gender_share("day_hits"),
    "sale_search_document": _document("day_hits", 5),
    "table_view_page": _page("day_hits", "5", "5"),
    "day_demographics": _demographics("day_hits"),
    "day_province_sales": f"""
SELECT province_id, {_money()} AS total_amount, count(*) AS order_count FROM order_info
WHERE create_date = '$ORDER_DAY$' GROUP BY province_id""",
    "day_product_sales": """
SELECT sku_name AS name, cast(sum(cast(sku_num AS bigint)) AS bigint) AS num FROM order_detail
WHERE order_id IN (SELECT id FROM order_info WHERE create_date = '$ORDER_DAY$') GROUP BY sku_name""",
    "device_windows": _windows(*WIDE) + f"""
SELECT mid, {_at("s", "window_start")}, {_at("e", "window_end")}, {LISTS}, clicked FROM windowed""",
    "coupon_alerts": _windows(*WIDE) + ALERTS,
    "coupon_alerts_5min": _windows(300, 5) + ALERTS,
    "alerts_per_minute": _windows(*DENSE) + PER_MINUTE,
    "stream_dau": DAU_ROWS,
    "day_scan": f"SELECT * FROM ({DAU_ROWS}) WHERE log_date = '$DAU_DAY$'",
    "stream_kpi_board": _kpis(DAU_DAY),
    "stream_kpi_board_orders": _kpis(ORDER_DAY),
    "stream_dau_compacted": DAU_ROWS,
    "stream_first_order_flag": FLAGS,
    "stream_sale_detail": "SELECT * FROM sale_detail",
    "stream_sale_detail_repaired": "SELECT * FROM sale_detail",
    "stream_latest_users": LATEST_USERS,
    "stream_alerts_per_minute": _windows(*WIDE) + PER_MINUTE,
    "stream_alerts_5min": _windows(300, 5) + PER_MINUTE,
}

BODIES["stream_ingest_logs"] = BODIES["route_logs"]
BODIES["stream_ingest_changes"] = BODIES["route_changes"]

ORACLE = {name: _fill(VIEWS + body) for name, body in BODIES.items()}
