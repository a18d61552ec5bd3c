"""DuckDB SQL for every catalog query: an independent statement of each answer.

Written directly against the driver tables (no shared code with the Spark
side).  Windows are epoch aligned; ``time_bucket`` agrees with that for
widths dividing a day.  Sliding windows are enumerated per row.
"""

_ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _sliding(src: str, key_cols: str, size: str, slide: str, out: str) -> str:
    """Per-key counts over sliding windows: each row goes to size/slide windows."""
    return f"""
    SELECT {key_cols}, window_end - INTERVAL {size} AS window_start, window_end,
           CAST(count(*) AS BIGINT) AS {out}
    FROM (SELECT {key_cols},
                 unnest(generate_series(time_bucket(INTERVAL {slide}, ts) + INTERVAL {slide},
                                        time_bucket(INTERVAL {slide}, ts) + INTERVAL {size},
                                        INTERVAL {slide})) AS window_end
          FROM ({src}))
    GROUP BY ALL"""


_VIEWS = f"SELECT user_id, {_ITEM} AS item_id, ts, event_id FROM events WHERE event_type = 'view'"
_ITEM_COUNTS = _sliding(_VIEWS, "item_id", "1 day", "1 hour", "view_count")
_GETS = f"SELECT '/item/' || CAST({_ITEM} AS VARCHAR) AS url, ts FROM events WHERE event_type = 'click'"
_MARKET = """SELECT CASE user_id % 5 WHEN 0 THEN 'wechat' WHEN 1 THEN 'weibo' WHEN 2 THEN 'xiaomistore'
                 WHEN 3 THEN 'appstore' ELSE 'huaweistore' END AS channel, event_type AS behavior, ts
             FROM events WHERE event_type <> 'error'"""
_ADS_RANKED = f"""SELECT event_id, user_id, {_ITEM} % 2 AS ad_id,
                 CASE user_id % 4 WHEN 0 THEN 'beijing' WHEN 1 THEN 'anhui' WHEN 2 THEN 'shanghai'
                 ELSE 'zhejiang' END AS province, ts, CAST(ts AS DATE) AS day,
                 row_number() OVER (PARTITION BY user_id, {_ITEM} % 2, CAST(ts AS DATE)
                                    ORDER BY ts, event_id) AS rk
             FROM events"""
_HASH = ("list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), "
         "lambda a, c: ((a * 61 + c) & 536870911), CAST(0 AS BIGINT))")
_TX = """SELECT o.o_orderkey AS tx_id, o.o_orderdate AS pay_ts, l.l_shipdate AS receipt_ts,
                l.l_linenumber, l.l_partkey, l.l_suppkey
         FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
          AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 60 day AND o.o_orderdate + INTERVAL 60 day"""

_FIRST_LINES = """SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                   ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS k
                  FROM lineitem"""
_PAIRED = f"""SELECT o.o_orderkey AS tx_id, l.k FROM orders o JOIN ({_FIRST_LINES}) l
              ON o.o_orderkey = l.l_orderkey AND l.k = 1
             AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 60 day AND o.o_orderdate + INTERVAL 60 day"""

_PARTS = """WITH s AS (SELECT l_partkey AS part, l_shipdate AS ts, l_orderkey, l_linenumber, l_suppkey, l_returnflag,
                  row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS k
           FROM lineitem WHERE l_returnflag IN ('R', 'A')),
     r AS (SELECT * FROM s WHERE l_returnflag = 'R'), a AS (SELECT * FROM s WHERE l_returnflag = 'A')"""
_NEAR = "r.part = a.part AND a.ts BETWEEN r.ts - INTERVAL 10 day AND r.ts + INTERVAL 10 day"
_PAIR = ", ".join(f"{t}.{c} AS {p}{c}" for p, t in (("p_", "r"), ("r_", "a")) for c in ("ts", "l_orderkey", "l_linenumber", "l_suppkey"))
_BARE = "part, ts, l_orderkey, l_linenumber, l_suppkey"

ORACLE_SQL: dict[str, str] = {
    "hot_items_top5": f"""
        SELECT window_start, window_end, CAST(rk AS INTEGER) AS rank, item_id, view_count
        FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id) AS rk
              FROM ({_ITEM_COUNTS})) WHERE rk <= 5""",
    "hot_items_top10_upsert": f"""
        SELECT item_id, max(window_end) AS window_end, arg_max(view_count, window_end) AS view_count
        FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id) AS rk
              FROM ({_ITEM_COUNTS})) WHERE rk <= 10 GROUP BY item_id""",
    "hot_items_report": f"""
        SELECT window_end,
               'Time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10) ||
               string_agg('No' || CAST(rk AS VARCHAR) || ': item=' || CAST(item_id AS VARCHAR)
                          || ' views=' || CAST(view_count AS VARCHAR), chr(10) ORDER BY rk) AS report
        FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id) AS rk
              FROM ({_ITEM_COUNTS})) WHERE rk <= 5 GROUP BY window_end""",
    "hot_urls_top5": f"""
        SELECT window_start, window_end, CAST(rk AS INTEGER) AS rank, url, hits
        FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY hits DESC, url) AS rk
              FROM ({_sliding(_GETS, "url", "6 hour", "30 minute", "hits")})) WHERE rk <= 5""",
    "page_views": """
        SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start,
               time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end,
               CAST(count(*) AS BIGINT) AS pv
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "unique_visitors": """
        SELECT time_bucket(INTERVAL 1 day, ts) AS window_start,
               time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day AS window_end,
               CAST(count(DISTINCT user_id) AS BIGINT) AS uv
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "unique_visitors_bitmap": f"""
        SELECT time_bucket(INTERVAL 1 day, ts) AS window_start,
               time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day AS window_end,
               CAST(count(DISTINCT {_HASH}) AS BIGINT) AS uv
        FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "running_unique_visitors": """
        WITH v AS (SELECT event_id, user_id, ts, time_bucket(INTERVAL 1 day, ts) AS window_start
                   FROM events WHERE event_type = 'view'),
             f AS (SELECT *, row_number() OVER (PARTITION BY window_start, user_id ORDER BY ts, event_id) = 1
                             AS is_first FROM v),
             r AS (SELECT *, sum(CASE WHEN is_first THEN 1 ELSE 0 END)
                             OVER (PARTITION BY window_start ORDER BY ts, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS uv FROM f)
        SELECT event_id, user_id, ts, window_start, window_start + INTERVAL 1 day AS window_end,
               CAST(uv AS BIGINT) AS uv
        FROM r WHERE NOT is_first""",
    "running_unique_visitors_bitmap": f"""
        WITH v AS (SELECT event_id, user_id, ts, time_bucket(INTERVAL 1 day, ts) AS window_start,
                          {_HASH} AS off
                   FROM events WHERE event_type = 'view'),
             f AS (SELECT *, row_number() OVER (PARTITION BY window_start, off ORDER BY ts, event_id) = 1
                             AS is_first FROM v),
             r AS (SELECT *, sum(CASE WHEN is_first THEN 1 ELSE 0 END)
                             OVER (PARTITION BY window_start ORDER BY ts, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS uv FROM f)
        SELECT event_id, user_id, ts, window_start, window_start + INTERVAL 1 day AS window_end,
               CAST(uv AS BIGINT) AS uv
        FROM r WHERE NOT is_first""",
    "marketing_by_channel": _sliding(_MARKET, "channel, behavior", "1 day", "1 hour", "cnt"),
    "marketing_total": f"""
        SELECT window_start, window_end, 'total channel' AS channel, 'total' AS behavior, cnt
        FROM ({_sliding(_MARKET, "1 AS one", "1 day", "1 hour", "cnt")})""",
    "ad_clicks_capped": f"""
        SELECT event_id, user_id, ad_id, province, ts, day FROM ({_ADS_RANKED}) WHERE rk <= 2""",
    "ad_blacklist": f"""
        SELECT user_id, ad_id, day, ts, 'Click over 2 times today.' AS msg
        FROM ({_ADS_RANKED}) WHERE rk = 3""",
    "ad_clicks_by_province": _sliding(f"SELECT province, ts FROM ({_ADS_RANKED}) WHERE rk <= 2",
                                      "province", "1 day", "1 hour", "cnt"),
    "login_fail_pairs": """
        SELECT user_id, ts AS first_fail_time, next_ts AS last_fail_time, 'login fail' AS warning
        FROM (SELECT user_id, event_type, ts,
                     lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts
              FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
        WHERE event_type = 'error' AND next_type = 'error' AND next_ts < ts + INTERVAL 6 hour""",
    "order_pattern": """
        SELECT c.user_id, c.ts AS start_ts,
               CASE WHEN p.ts < c.ts + INTERVAL 1 day THEN p.ts END AS end_ts,
               CASE WHEN p.ts < c.ts + INTERVAL 1 day THEN 'match' ELSE 'timeout' END AS outcome
        FROM (SELECT * FROM events WHERE event_type = 'click') c
        LEFT JOIN LATERAL (SELECT min(e.ts) AS ts FROM events e
                           WHERE e.user_id = c.user_id AND e.event_type = 'purchase'
                             AND (e.ts > c.ts OR (e.ts = c.ts AND e.event_id > c.event_id))) p ON TRUE""",
    "order_state_machine": """
        WITH pay AS (SELECT l_orderkey AS order_id, min(l_shipdate) AS pay_ts FROM lineitem GROUP BY 1),
             cr AS (SELECT o_orderkey AS order_id, o_orderdate AS c FROM orders),
             m AS (SELECT coalesce(cr.order_id, pay.order_id) AS order_id,
                          max(CASE WHEN pay.pay_ts IS NULL OR cr.c <= pay.pay_ts THEN cr.c END) AS create_ts,
                          max(CASE WHEN cr.c IS NOT NULL THEN 1 ELSE 0 END) AS has_c,
                          min(pay.pay_ts) AS pay_ts
                   FROM cr FULL JOIN pay ON cr.order_id = pay.order_id GROUP BY 1)
        SELECT order_id, create_ts, pay_ts,
               CASE WHEN pay_ts IS NULL THEN 'order timeout'
                    WHEN create_ts IS NULL AND has_c = 1 THEN 'payed'
                    WHEN create_ts IS NULL THEN 'already pay but not found create'
                    WHEN pay_ts < create_ts + INTERVAL 365 day THEN 'payed successfully'
                    ELSE 'payed but already timeout' END AS result
        FROM m""",
    "tx_interval_join": _TX,
    "tx_match_one_to_one": """
        SELECT o.o_orderkey AS tx_id, o.o_orderdate AS pay_ts, l.l_shipdate AS receipt_ts,
               l.l_linenumber, l.l_partkey, l.l_suppkey
        FROM orders o
        JOIN (SELECT *, row_number() OVER (PARTITION BY l_orderkey
                                           ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey) AS k
              FROM lineitem) l
          ON o.o_orderkey = l.l_orderkey AND l.k = 1
         AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 60 day AND o.o_orderdate + INTERVAL 60 day""",
    "tx_unmatched_pays": f"""
        SELECT o_orderkey AS tx_id, o_orderdate AS ts FROM orders
        WHERE o_orderkey NOT IN (SELECT tx_id FROM ({_TX}))""",
    "tx_unmatched_receipts": """
        SELECT l.l_orderkey AS tx_id, l.l_shipdate AS ts, l.l_linenumber, l.l_partkey, l.l_suppkey
        FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey
                          AND l.l_shipdate BETWEEN o.o_orderdate - INTERVAL 60 day
                                               AND o.o_orderdate + INTERVAL 60 day)""",
    "tx_unmatched_pays_one_to_one": f"""
        SELECT o_orderkey AS tx_id, o_orderdate AS ts FROM orders
        WHERE o_orderkey NOT IN (SELECT tx_id FROM ({_PAIRED}))""",
    "tx_unmatched_receipts_one_to_one": f"""
        SELECT l.l_orderkey AS tx_id, l.l_shipdate AS ts, l.l_linenumber, l.l_partkey, l.l_suppkey
        FROM ({_FIRST_LINES}) l
        WHERE NOT EXISTS (SELECT 1 FROM ({_PAIRED}) p WHERE p.tx_id = l.l_orderkey AND p.k = l.k)""",
    "topic_lines": f"""
        SELECT event_id, user_id, {_ITEM} AS item_id, CAST({_ITEM} % 10 AS INTEGER) AS category_id,
               event_type AS behavior, CAST(floor(epoch(ts)) AS BIGINT) AS ts_s
        FROM events""",
    "behaviour_lines_trimmed": f"""
        SELECT event_id, user_id, {_ITEM} AS item_id, CAST(7 AS INTEGER) AS category_id,
               event_type AS behavior, CAST(floor(epoch(ts)) AS BIGINT) AS ts_s
        FROM events""",
    "access_log_lines": f"""
        SELECT event_id, '10.0.0.1' AS ip, CAST(user_id AS VARCHAR) AS user_id,
               CASE WHEN event_type = 'click' THEN 'GET' ELSE upper(event_type) END AS method,
               '/item/' || CAST({_ITEM} AS VARCHAR) AS url, CAST(floor(epoch(ts)) AS BIGINT) AS ts_s
        FROM events""",
    "login_lines": """
        SELECT event_id, user_id, '10.0.0.1' AS ip,
               CASE WHEN event_type = 'error' THEN 'fail' ELSE 'success' END AS event_type,
               CAST(floor(epoch(ts)) AS BIGINT) AS ts_s
        FROM events WHERE user_id % 7 <> 0""",
    "order_lines_paid": """
        SELECT o_orderkey AS order_id, 'pay' AS event_type, 'tx' || CAST(o_orderkey AS VARCHAR) AS tx_id,
               CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ts_s
        FROM orders WHERE o_orderkey % 3 <> 0""",
    "receipt_lines": """
        SELECT 'tx' || CAST(l_orderkey AS VARCHAR) AS tx_id, l_returnflag AS pay_channel,
               CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts_s, l_linenumber
        FROM lineitem""",
    "hot_urls_corrected": f"""
        SELECT window_start, window_end, CAST(rk AS INTEGER) AS rank, url, hits
        FROM (SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY hits DESC, url) AS rk
              FROM ({_sliding(_GETS, "url", "6 hour", "30 minute", "hits")})) WHERE rk <= 5""",
    "hot_items_documents": f"""
        SELECT w || '-' || CAST(rk AS VARCHAR) AS id,
               '{{"window":"' || w || '","rank":' || CAST(rk AS VARCHAR) || ',"item_id":' || CAST(item_id AS VARCHAR)
               || ',"view_count":' || CAST(view_count AS VARCHAR) || '}}' AS doc
        FROM (SELECT *, strftime(window_end, '%Y-%m-%d %H:%M:%S') AS w,
                     row_number() OVER (PARTITION BY window_end ORDER BY view_count DESC, item_id) AS rk
              FROM ({_ITEM_COUNTS})) WHERE rk <= 5""",
    "unique_visitor_lines": """
        SELECT strftime(time_bucket(INTERVAL 1 day, ts) + INTERVAL 1 day, '%Y-%m-%d %H:%M:%S') || ','
               || CAST(count(DISTINCT user_id) AS VARCHAR) AS value
        FROM events WHERE event_type = 'view' GROUP BY time_bucket(INTERVAL 1 day, ts)""",
    "part_interval_join": f"{_PARTS} SELECT r.part, {_PAIR} FROM r JOIN a ON {_NEAR}",
    "part_one_to_one": f"{_PARTS} SELECT r.part, {_PAIR} FROM r JOIN a ON {_NEAR} AND r.k = a.k",
    "part_unmatched_left": f"{_PARTS} SELECT {_BARE} FROM r WHERE NOT EXISTS (SELECT 1 FROM a WHERE {_NEAR})",
    "part_unmatched_right": f"{_PARTS} SELECT {_BARE} FROM a WHERE NOT EXISTS (SELECT 1 FROM r WHERE {_NEAR})",
    "part_unmatched_one_to_one": f"""{_PARTS}
        SELECT {_BARE}, 'returned' AS side FROM r WHERE NOT EXISTS (SELECT 1 FROM a WHERE {_NEAR} AND r.k = a.k)
        UNION ALL
        SELECT {_BARE}, 'accepted' AS side FROM a WHERE NOT EXISTS (SELECT 1 FROM r WHERE {_NEAR} AND r.k = a.k)""",
    "hot_url_rank_changes": f"""
        WITH c AS (SELECT '/item/' || CAST({_ITEM} AS VARCHAR) AS url, event_id % 3 AS ep, time_bucket(INTERVAL 1 day, ts) AS w
                   FROM events WHERE event_type = 'click'),
             n AS (SELECT e AS epoch, w, url, count(*) AS hits FROM c JOIN (VALUES (0), (1), (2)) v(e) ON c.ep <= e GROUP BY ALL),
             t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY epoch, w ORDER BY hits DESC, url) AS rk FROM n) WHERE rk <= 5)
        SELECT CAST(t.epoch AS BIGINT) AS epoch, t.w AS window_start, t.w + INTERVAL 1 day AS window_end, CAST(t.rk AS INTEGER) AS rank, t.url, t.hits
        FROM t WHERE NOT EXISTS (SELECT 1 FROM t o WHERE o.epoch = t.epoch - 1 AND o.w = t.w AND o.rk = t.rk AND o.url = t.url AND o.hits = t.hits)""",
}
