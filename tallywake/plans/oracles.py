"""The same results in DuckDB SQL, by query name."""

from __future__ import annotations

_ITEMS = "items AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events)"

# The access log of `queries.log_lines`, as typed rows.
_LOG = _ITEMS + """,
log AS (
    SELECT event_id, event_id % 4 AS source, event_id + (event_id * 7919) % 97 AS arrival,
           '10.0.0.' || (user_id % 256) AS ip, CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS ts,
           CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'POST' END AS method,
           '/' || event_type || '/' || (item_id % 10) || ['.css', '.js', '.html', ''][item_id % 4 + 1] AS url
    FROM items
),
requests AS (SELECT * FROM log WHERE method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png)$'))"""


def _sliding(source: str, keys: str, size: str, slide: str, name: str = "counts") -> str:
    """CTEs that put every row in all its windows by way of its pane."""
    return f"""
panes AS (SELECT {keys}, time_bucket(INTERVAL '{slide}', ts) + INTERVAL '{slide}' AS pane_end, count(*) AS n
          FROM {source} GROUP BY ALL),
placed AS (SELECT {keys}, n, unnest(generate_series(pane_end, pane_end + INTERVAL '{size}' - INTERVAL '{slide}',
                                                    INTERVAL '{slide}')) AS window_end FROM panes),
{name} AS (SELECT {keys}, window_end, CAST(sum(n) AS BIGINT) AS cnt FROM placed GROUP BY ALL)"""


def _top(key: str, n: int, source: str = "counts") -> str:
    return f"""SELECT {key}, window_end, cnt, row_num FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, {key}) AS INTEGER) AS row_num
    FROM {source}) WHERE row_num <= {n}"""


def _report(ranked: str, line: str) -> str:
    return f"""SELECT window_end, '==================================' || chr(10) || '时间:' ||
    strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) ||
    string_agg({line} || chr(10), '' ORDER BY row_num) || '==================================' || chr(10) AS report
FROM ({ranked}) GROUP BY window_end"""


_VIEWS = "views AS (SELECT * FROM items WHERE event_type = 'view')"
_HOT_ITEMS = f"WITH {_ITEMS}, {_VIEWS}, {_sliding('views', 'item_id', '1 hour', '5 minutes')} "
_HOT_PAGES = f"WITH {_LOG}, {_sliding('requests', 'url', '10 minutes', '5 seconds')} "

_ARRIVED = f"""WITH {_LOG},
seen AS (SELECT *, max(ts) OVER (PARTITION BY source ORDER BY arrival, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '4 hours' AS watermark
         FROM log),
asked AS (SELECT * FROM seen WHERE method = 'GET' AND NOT regexp_matches(url, '\\.(css|js|png)$')),
placed AS (
    SELECT *, unnest(generate_series(time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '5 minutes',
                                     time_bucket(INTERVAL '5 minutes', ts) + INTERVAL '2 hours',
                                     INTERVAL '5 minutes')) AS window_end
    FROM asked),
open AS (SELECT * FROM placed WHERE watermark IS NULL
         OR window_end - INTERVAL '1 millisecond' + INTERVAL '30 minutes' > watermark)"""

_CAPPED = """WITH ranked AS (
    SELECT event_id, user_id, event_type AS ad_id, event_type AS province, ts,
           row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth
    FROM events)"""


def _bursts(events: str, min_fails: int, within: str) -> str:
    """The burst rule row by row, all users at once."""
    return f"""WITH RECURSIVE numbered AS (
    SELECT user_id, ts, event_type = 'error' AS fail,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
           count(*) OVER (PARTITION BY user_id) AS total
    FROM {events}),
walk AS (
    SELECT user_id, rn, total, CASE WHEN fail THEN ts END AS opened, CASE WHEN fail THEN 1 ELSE 0 END AS n,
           ts AS last_fail, CAST(NULL AS TIMESTAMP) AS first_ts, CAST(NULL AS TIMESTAMP) AS last_ts
    FROM numbered WHERE rn = 1
    UNION ALL
    SELECT e.user_id, e.rn, e.total,
           CASE WHEN NOT e.fail THEN NULL WHEN w.opened IS NULL OR e.ts > w.opened + INTERVAL '{within}' THEN e.ts
                ELSE w.opened END,
           CASE WHEN NOT e.fail THEN 0 WHEN w.opened IS NULL OR e.ts > w.opened + INTERVAL '{within}' THEN 1
                ELSE w.n + 1 END,
           CASE WHEN e.fail THEN e.ts ELSE w.last_fail END,
           CASE WHEN w.n >= {min_fails} AND e.ts > w.opened + INTERVAL '{within}' THEN w.opened END,
           CASE WHEN w.n >= {min_fails} AND e.ts > w.opened + INTERVAL '{within}' THEN w.last_fail END
    FROM walk w JOIN numbered e ON e.user_id = w.user_id AND e.rn = w.rn + 1)
SELECT user_id, first_ts, last_ts, '说你又有不听，听你又不做，做了又做错，错了你也不认，认了还不改，改了也不服' AS msg
FROM (SELECT user_id, first_ts, last_ts FROM walk WHERE first_ts IS NOT NULL
      UNION ALL
      SELECT user_id, opened, last_fail FROM walk WHERE rn = total AND n >= {min_fails})"""


def _in_a_row(n: int, within: str | None, msg: str) -> str:
    lags = ", ".join(f"lag(event_type, {i}) OVER w AS e{i}, lag(ts, {i}) OVER w AS t{i}" for i in range(1, n))
    fails = " AND ".join(["event_type = 'error'", *[f"e{i} = 'error'" for i in range(1, n)]])
    bound = f" AND ts - t{n - 1} < INTERVAL '{within}'" if within else ""
    return f"""SELECT user_id, t{n - 1} AS first_ts, ts AS last_ts, '{msg}' AS msg
FROM (SELECT user_id, event_type, ts, {lags} FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE {fails}{bound}"""


def _match(keys: list[str], before: str, after: str, first: bool = False) -> str:
    def side(kind: str) -> str:
        part = ", ".join(keys)
        only = f"QUALIFY row_number() OVER (PARTITION BY {part} ORDER BY ts, event_id) = 1" if first else ""
        return f"SELECT {part}, ts, event_id, value FROM items WHERE event_type = '{kind}' {only}"

    same = " AND ".join(f"l.{k} = r.{k}" for k in keys)
    names = ", ".join(f"coalesce(l.{k}, r.{k}) AS {k}" for k in keys)
    return f"""WITH {_ITEMS}, l AS ({side('purchase')}), r AS ({side('click')})
SELECT {names}, l.ts AS l_ts, l.event_id AS l_event_id, l.value AS l_value,
       r.ts AS r_ts, r.event_id AS r_event_id, r.value AS r_value,
       CASE WHEN r.event_id IS NULL THEN 'no_receipt' WHEN l.event_id IS NULL THEN 'no_pay' ELSE 'matched' END AS outcome
FROM l FULL JOIN r ON {same} AND r.ts BETWEEN l.ts - INTERVAL '{before}' AND l.ts + INTERVAL '{after}'"""


def _one_to_one(before: str, after: str) -> str:
    """The pairing rule row by row, all users at once: `q` holds the rows that wait, all of one side."""
    def us(of: str) -> str:
        return f"epoch_us(TIMESTAMP '1970-01-01' + INTERVAL '{of}')"

    return f"""WITH RECURSIVE numbered AS (
    SELECT user_id, epoch_us(ts) AS us, event_type = 'purchase' AS pay, event_id, ts, value,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type = 'click', event_id) AS rn,
           CASE WHEN event_type = 'purchase' THEN {us(after)} ELSE {us(before)} END AS wait
    FROM events WHERE event_type IN ('purchase', 'click')),
walk AS (
    SELECT user_id, rn, [{{'id': event_id, 'pay': pay, 'until': us + wait}}] AS q,
           CAST(NULL AS BIGINT) AS l_event_id, CAST(NULL AS BIGINT) AS r_event_id
    FROM numbered WHERE rn = 1
    UNION ALL
    SELECT user_id, rn,
           CASE WHEN len(open) > 0 AND open[1].pay <> pay THEN open[2:]
                ELSE list_append(open, {{'id': event_id, 'pay': pay, 'until': us + wait}}) END,
           CASE WHEN len(open) > 0 AND open[1].pay <> pay THEN CASE WHEN pay THEN event_id ELSE open[1].id END END,
           CASE WHEN len(open) > 0 AND open[1].pay <> pay THEN CASE WHEN pay THEN open[1].id ELSE event_id END END
    FROM (SELECT e.*, [x FOR x IN w.q IF x.until >= e.us] AS open
          FROM walk w JOIN numbered e ON e.user_id = w.user_id AND e.rn = w.rn + 1)),
found AS (
    SELECT l_event_id, r_event_id FROM walk WHERE l_event_id IS NOT NULL
    UNION ALL
    SELECT event_id, NULL FROM numbered WHERE pay AND event_id NOT IN (SELECT l_event_id FROM walk WHERE l_event_id IS NOT NULL)
    UNION ALL
    SELECT NULL, event_id FROM numbered WHERE NOT pay AND event_id NOT IN (SELECT r_event_id FROM walk WHERE r_event_id IS NOT NULL))
SELECT coalesce(l.user_id, r.user_id) AS user_id, l.ts AS l_ts, l.event_id AS l_event_id, l.value AS l_value,
       r.ts AS r_ts, r.event_id AS r_event_id, r.value AS r_value,
       CASE WHEN r.event_id IS NULL THEN 'no_receipt' WHEN l.event_id IS NULL THEN 'no_pay' ELSE 'matched' END AS outcome
FROM found LEFT JOIN events l ON l.event_id = l_event_id LEFT JOIN events r ON r.event_id = r_event_id"""


_HOURLY_VIEWS = """SELECT time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt
FROM events WHERE event_type = 'view' GROUP BY ALL"""

_RECORD = "user_id || ',' || item_id || ',' || (item_id % 7) || ',' || event_type || ',' || CAST(floor(epoch(ts)) AS BIGINT)"

ORACLES: dict[str, str] = {
    "hot_items_topn": _HOT_ITEMS + _top("item_id", 3),
    "hot_items_all": _HOT_ITEMS + _top("item_id", 2000),
    "hot_items_sql": _HOT_ITEMS + _top("item_id", 5),
    "rank_report_items": _HOT_ITEMS + _report(
        _top("item_id", 3), "'No' || row_num || ':商品ID=' || item_id || '浏览量=' || cnt"),
    "hot_pages_topn": _HOT_PAGES + _top("url", 5),
    "rank_report_pages": _HOT_PAGES + _report(
        _top("url", 5), "'No' || row_num || ':URL=' || url || chr(9) || '热度=' || cnt"),
    "hot_pages_by_arrival": _ARRIVED + """,
counts AS (SELECT url, window_end, count(*) AS cnt FROM open GROUP BY ALL) """ + _top("url", 5),
    "hot_pages_late_rows": _ARRIVED + """
SELECT event_id, url, ts, watermark FROM asked WHERE event_id NOT IN (SELECT event_id FROM open)""",
    "static_asset_filter": """SELECT * FROM (
    SELECT page_id, url || '.' || ['css', 'js', 'png', 'html'][page_id % 4 + 1] AS url FROM pages)
WHERE NOT regexp_matches(url, '\\.(css|js|png)$')""",
    "page_views_hourly": _HOURLY_VIEWS,
    "page_views_salted": _HOURLY_VIEWS,
    "unique_visitors_hourly": _HOURLY_VIEWS.replace("count(*)", "count(DISTINCT user_id)"),
    "behavior_counts_hourly": """SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS window_start,
    time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(*) AS cnt, max(value) AS max_value
FROM events GROUP BY ALL""",
    "daily_unique_users": """SELECT time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
    count(DISTINCT user_id) AS cnt FROM events GROUP BY ALL""",
    "click_cap_total": _CAPPED + " SELECT event_id, user_id, ad_id, ts FROM ranked WHERE nth <= 10",
    "click_cap_large": """SELECT event_id, event_type AS ad_id, ts, nth, CASE WHEN nth <= 1500 THEN 'pass' ELSE 'blacklist' END AS outcome
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nth FROM events) WHERE nth <= 1501""",
    "click_blacklist": _CAPPED + """
SELECT user_id, ad_id, ts, '看广告有瘾，建议送到精神病院' AS msg FROM ranked WHERE nth = 11""",
    "click_cap_daily": """WITH days AS (
    SELECT event_id, user_id, event_type AS ad_id, ts, CAST(ts + INTERVAL '8 hours' AS DATE) AS day FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, day ORDER BY ts, event_id) AS nth FROM days)
SELECT event_id, user_id, ad_id, ts, CAST(day AS VARCHAR) AS day, CASE WHEN nth = 1 THEN 'pass' ELSE 'blacklist' END AS outcome
FROM ranked WHERE nth <= 2""",
    "ad_clicks_sliding": _CAPPED + ", kept AS (SELECT * FROM ranked WHERE nth <= 10)," + _sliding(
        "kept", "province", "1 hour", "5 seconds") + " SELECT * FROM counts",
    "market_by_channel": f"WITH {_ITEMS}" + """,
actions AS (SELECT 'c' || (item_id % 6) AS channel, upper(event_type) AS behavior,
                   time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS pane_end
            FROM items WHERE event_type <> 'signup'),
changes AS (SELECT channel, behavior, pane_end AS happens, 1 AS delta FROM actions
            UNION ALL SELECT channel, behavior, pane_end + INTERVAL '1 day', -1 FROM actions),
net AS (SELECT channel, behavior, happens, sum(delta) AS delta FROM changes GROUP BY ALL HAVING sum(delta) <> 0),
level AS (SELECT channel, behavior, happens AS from_end, lead(happens) OVER w AS to_end,
                 CAST(sum(delta) OVER w AS BIGINT) AS cnt
          FROM net WINDOW w AS (PARTITION BY channel, behavior ORDER BY happens))
SELECT * FROM level WHERE cnt > 0""",
    "market_by_channel_windows": f"WITH {_ITEMS}" + """,
actions AS (SELECT 'c' || (item_id % 6) AS channel, upper(event_type) AS behavior, ts FROM items WHERE event_type <> 'signup'),""" + _sliding(
        "actions", "channel, behavior", "1 day", "1 hour") + " SELECT window_end - INTERVAL '1 day' AS window_start, * FROM counts",
    "login_fail_burst": _bursts("events", 2, "24 hours"),
    "login_fail_burst_long": _bursts("(SELECT * FROM events WHERE event_type IN ('error', 'purchase'))", 3, "2 days"),
    "login_fail_pair": _in_a_row(2, "12 hours", "login fail 2 times in 2s"),
    "login_fail_pair_unbounded": _in_a_row(2, None, "login fail 2 times in 2s"),
    "login_fail_pattern": _in_a_row(3, "1 day", "login fail"),
    "order_pay_pattern": """WITH nexts AS (
    SELECT user_id, event_type, ts,
           min(ts) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pay
    FROM events)
SELECT user_id, ts AS start_ts, CASE WHEN next_pay < ts + INTERVAL '1 day' THEN next_pay END AS then_ts,
       CASE WHEN next_pay < ts + INTERVAL '1 day' THEN 'paid' ELSE 'timeout' END AS outcome,
       CASE WHEN next_pay < ts + INTERVAL '1 day' THEN NULL ELSE ts + INTERVAL '1 day' END AS timeout_ts
FROM nexts WHERE event_type = 'signup'""",
    "order_lifecycle": f"WITH {_ITEMS}" + """,
firsts AS (SELECT user_id, item_id, min(ts) FILTER (event_type = 'signup') AS create_ts,
                  min(ts) FILTER (event_type = 'purchase') AS pay_ts
           FROM items WHERE event_type IN ('signup', 'purchase') GROUP BY ALL)
SELECT *, CASE WHEN create_ts IS NULL OR pay_ts < create_ts THEN 'paid_no_create'
               WHEN pay_ts < create_ts + INTERVAL '3 days' THEN 'paid'
               WHEN pay_ts <= create_ts + INTERVAL '10 days' THEN 'paid_late' ELSE 'unpaid' END AS outcome
FROM firsts""",
    "pay_receipt_match": _match(["user_id", "item_id"], "3 days", "5 days"),
    "pay_receipt_match_first": _match(["user_id", "item_id"], "3 days", "5 days", first=True),
    "pay_receipt_match_users": _match(["user_id"], "10 minutes", "20 minutes"),
    "pay_receipt_match_pairs": _one_to_one("12 hours", "1 day"),
    "late_rows": """WITH seen AS (
    SELECT event_id, ts, event_id % 4 AS source, event_id + (event_id * 7919) % 97 AS arrival FROM events),
marked AS (SELECT *, max(ts) OVER (PARTITION BY source ORDER BY arrival, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '4 hours' AS watermark
           FROM seen)
SELECT *, coalesce(time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' - INTERVAL '1 millisecond' <= watermark,
                   false) AS is_late
FROM marked""",
    "log_lines_parse": f"WITH {_LOG} SELECT event_id, ip, user_id, ts, method, url FROM log",
    "record_lines": f"WITH {_ITEMS} SELECT event_id, {_RECORD} AS value FROM items",
    "record_lines_parse": f"WITH {_ITEMS}" + """
SELECT event_id, user_id, item_id, CAST(item_id % 7 AS INTEGER) AS category_id, event_type AS behavior,
       CAST(floor(epoch(ts)) AS BIGINT) AS timestamp, date_trunc('second', ts) AS ts
FROM items""",
    **{f"record_lines_{name}": f"WITH {_ITEMS}" + f"""
SELECT event_id, {columns}, {'epoch_us(ts) // 1000' if name == 'market' else 'CAST(floor(epoch(ts)) AS BIGINT)'} AS timestamp,
       date_trunc('{'millisecond' if name == 'market' else 'second'}', ts) AS ts
FROM items WHERE {where}""" for name, columns, where in (
        ("ad_clicks", "user_id, item_id AS ad_id, event_type AS province, 'c' || (user_id % 3) AS city", "true"),
        ("logins", "user_id, '10.0.0.' || (user_id % 256) AS ip, CASE event_type WHEN 'error' THEN 'fail' ELSE 'success' END AS event_type", "true"),
        ("orders", "user_id AS order_id, CASE event_type WHEN 'purchase' THEN 'pay' ELSE 'create' END AS event_type, "
                   "CASE event_type WHEN 'purchase' THEN 't' || item_id END AS tx_id", "event_type IN ('signup', 'purchase')"),
        ("receipts", "'t' || item_id AS tx_id, CASE user_id % 2 WHEN 0 THEN 'wechat' ELSE 'alipay' END AS pay_channel", "event_type = 'click'"),
        ("market", "CAST(user_id AS VARCHAR) AS user_id, upper(event_type) AS behavior, 'c' || (item_id % 6) AS channel", "true"))},
    "window_arith": """SELECT event_id,
    time_bucket(INTERVAL '1 hour', ts - INTERVAL '15 minutes') + INTERVAL '15 minutes' AS hour_start,
    epoch_us(ts) // 1000 - epoch_us(ts) // 1000 % 5000 AS five_second_start_ms,
    date_trunc('day', ts) + INTERVAL '1 day' AS midnight, epoch_us(ts) // 1000 AS ms,
    strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') || '.0' AS printed
FROM events""",
}


_OUTCOMES = """SELECT event_id, user_id, ad_id, ts, CASE WHEN nth <= {0} THEN 'pass' ELSE 'blacklist' END AS outcome
FROM ranked WHERE nth <= {0} + 1"""


def _only(sql: str, *columns: str) -> str:
    return f"SELECT {', '.join(columns)} FROM ({sql})"


# A stream that has come to its end has given what the batch job gives.
ORACLES |= {
    "stream_hot_items_topn": ORACLES["hot_items_topn"],
    "stream_hot_pages_topn": ORACLES["hot_pages_topn"],
    "stream_page_views_hourly": ORACLES["page_views_hourly"],
    "stream_page_views_salted": ORACLES["page_views_hourly"],
    "stream_unique_visitors_hourly": ORACLES["unique_visitors_hourly"],
    "stream_click_outcomes": _CAPPED + _OUTCOMES.format(10),
    "stream_click_sides": f"""SELECT event_id, ts, CASE WHEN ad_id <> 'signup' THEN outcome END AS outcome,
    CASE WHEN ad_id = 'signup' THEN 'others' WHEN outcome = 'pass' THEN 'clicks' ELSE 'warnings' END AS side
FROM ({_CAPPED + _OUTCOMES.format(10)})""",
    "stream_click_cap_daily": _only(ORACLES["click_cap_daily"], "event_id", "user_id", "ad_id", "ts", "outcome"),
    "stream_ad_clicks_sliding": _CAPPED + """,
panes AS (SELECT province, time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS pane_end
          FROM ranked WHERE nth <= 10),
changes AS (SELECT province, pane_end AS happens, 1 AS delta FROM panes
            UNION ALL SELECT province, pane_end + INTERVAL '1 hour', -1 FROM panes),
net AS (SELECT province, happens, sum(delta) AS delta FROM changes GROUP BY ALL HAVING sum(delta) <> 0),
level AS (SELECT province, happens AS from_end, lead(happens) OVER w AS to_end, CAST(sum(delta) OVER w AS BIGINT) AS cnt
          FROM net WINDOW w AS (PARTITION BY province ORDER BY happens))
SELECT * FROM level WHERE cnt > 0""",
    "stream_market_by_channel": ORACLES["market_by_channel"],
    "stream_login_fail_burst": ORACLES["login_fail_burst"],
    "stream_login_fail_pair": ORACLES["login_fail_pair"],
    "stream_login_fail_pattern": ORACLES["login_fail_pattern"],
    "stream_order_pay_pattern": ORACLES["order_pay_pattern"],
    "stream_order_lifecycle": ORACLES["order_lifecycle"],
    "stream_pay_receipt_match": _only(
        ORACLES["pay_receipt_match"], "user_id", "item_id", "l_ts", "l_event_id", "r_ts", "r_event_id", "outcome"),
    "stream_pay_receipt_pairs": ORACLES["pay_receipt_match_pairs"],
    "stream_late_rows": ORACLES["late_rows"],
    "stream_late_requests": ORACLES["hot_pages_late_rows"],
}
