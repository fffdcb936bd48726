"""Independent ANSI SQL for the registered queries, over the same tables."""

from __future__ import annotations

TIME = "'%Y-%m-%d %H:%M:%S'"


def _window(ts: str, seconds: int) -> str:
    """Epoch-aligned start of the window that holds ``ts``, in microseconds."""
    width = seconds * 1_000_000
    return f"(epoch_us({ts}) // {width}) * {width}"


def _label(us: str) -> str:
    return f"strftime(make_timestamp({us}), {TIME})"


DAY = 86_400

ORDER_INFO = """
order_info AS (
    SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id,
           o_orderstatus AS order_status, o_custkey AS user_id,
           CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount, o_orderdate AS rowtime
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
)"""
ORDER_DETAIL = """
order_detail AS (
    SELECT CAST(l_linenumber AS BIGINT) AS id, l_orderkey AS order_id,
           l_partkey AS sku_id, CAST(l_quantity AS BIGINT) AS sku_num,
           CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
           CAST(l_extendedprice AS DECIMAL(16,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
               AS split_total_amount,
           l_shipdate AS rowtime
    FROM lineitem
)"""


def _joined(low: str = ">=", high: str = "<=") -> str:
    return f"""
joined AS (
    SELECT d.id AS detail_id, o.id AS order_id, d.sku_id, d.order_price, d.sku_num,
           d.split_total_amount, o.province_id, o.order_status, o.user_id,
           o.total_amount, o.rowtime
    FROM order_info o JOIN order_detail d ON o.id = d.order_id
     AND d.rowtime {low} o.rowtime - INTERVAL '5' DAY
     AND d.rowtime {high} o.rowtime + INTERVAL '5' DAY
)"""


JOINED = f"{ORDER_INFO},{ORDER_DETAIL},{_joined()}"

AS_OF = "TIMESTAMP '2024-01-01 00:00:00'"

SKU = """
sku AS (
    SELECT p_partkey AS id, p_name AS sku_name,
           CAST(p_retailprice AS DECIMAL(16,2)) AS sku_price, p_type AS category3_id,
           CAST(p_size AS BIGINT) AS spu_id, p_brand AS tm_id,
           concat('spu-', CAST(p_size AS VARCHAR)) AS spu_name,
           concat('tm-', p_brand) AS tm_name, lower(p_type) AS category3_name
    FROM part
)"""

WIDE = f"""{JOINED},{SKU},
users AS (
    SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
           DATE '1960-01-01' + CAST(c_custkey % 14000 AS INT) AS birthday
    FROM customer
),
wide AS (
    SELECT j.*, strftime(j.rowtime, {TIME}) AS create_time,
           strftime(j.rowtime, '%Y-%m-%d') AS create_date,
           strftime(j.rowtime, '%H') AS create_hour,
           u.gender AS user_gender,
           CAST(floor((epoch_ms({AS_OF}) - epoch_ms(CAST(u.birthday AS TIMESTAMP)))
                / 31536000000.0) AS INTEGER) AS user_age,
           n_name AS province_name, CAST(n_regionkey AS VARCHAR) AS province_area_code,
           substr(n_name, 1, 3) AS province_iso_code,
           concat('X-', substr(n_name, 1, 2)) AS province_3166_2_code,
           s.sku_name, s.category3_id, s.spu_id, s.tm_id, s.spu_name, s.tm_name,
           s.category3_name
    FROM joined j
    LEFT JOIN users u ON j.user_id = u.id
    LEFT JOIN nation ON j.province_id = n_nationkey
    LEFT JOIN sku s ON j.sku_id = s.id
)"""

PAYMENT = """
payment_info AS (
    SELECT o_orderkey AS id, o_orderkey AS order_id, o_custkey AS user_id,
           CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
           CASE o_orderkey % 3 WHEN 0 THEN '1101' WHEN 1 THEN '1102' ELSE '1103' END
               AS payment_type,
           o_orderdate + (o_orderkey % 30) * INTERVAL '1' MINUTE AS rowtime
    FROM orders WHERE o_orderstatus = 'F'
)"""


def _paid(wide: str) -> str:
    return f"""
paid AS (
    SELECT p.id AS payment_id, p.payment_type, p.rowtime AS payment_time,
           p.order_id, p.user_id, p.total_amount,
           w.rowtime AS order_time, w.* EXCLUDE (order_id, user_id, total_amount, rowtime)
    FROM payment_info p JOIN {wide} w ON p.order_id = w.order_id
     AND w.rowtime >= p.rowtime - INTERVAL '15' MINUTE AND w.rowtime <= p.rowtime
)"""


PAGES = """
pages_log AS (
    SELECT event_id, CAST(user_id AS VARCHAR) AS mid, ts,
           CASE WHEN event_type = 'click' THEN 'good_detail' ELSE event_type END AS page_id,
           CASE WHEN event_type = 'view' THEN NULL ELSE 'home' END AS last_page_id,
           concat('v', CAST(event_id % 3 AS VARCHAR)) AS vc,
           concat('c', CAST(event_id % 4 AS VARCHAR)) AS ch,
           CAST(user_id % 25 AS VARCHAR) AS ar, CAST(event_id % 2 AS VARCHAR) AS is_new,
           CAST(floor(value) AS BIGINT) AS during_time, event_id % 2000 AS item
    FROM events
)"""
DISPLAYS = """
shown AS (
    SELECT p.ts, p.page_id, CAST((p.event_id + k.k) % 2000 AS VARCHAR) AS item,
           CASE WHEN (p.event_id + k.k) % 5 = 0 THEN 'promo_id' ELSE 'sku_id' END
               AS item_type
    FROM pages_log p JOIN (VALUES (0), (1)) AS k(k) ON k.k < p.event_id % 3
)"""
VISITS = """
visits AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (
            PARTITION BY mid, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn
        FROM pages_log WHERE last_page_id IS NULL
    ) WHERE rn = 1
)"""
BOUNCES = """
followed AS (
    SELECT *, last_page_id IS NULL AS entry,
           lead(ts) OVER (PARTITION BY mid ORDER BY ts, event_id) AS next_ts,
           lead(last_page_id IS NULL) OVER (PARTITION BY mid ORDER BY ts, event_id)
               AS next_entry
    FROM pages_log
),
bounced AS (
    SELECT *, CASE WHEN next_ts IS NULL OR next_ts >= ts + INTERVAL '6' HOUR
                   THEN 'timeout' ELSE 'matched' END AS reason
    FROM followed
    WHERE entry AND (next_ts IS NULL OR next_ts >= ts + INTERVAL '6' HOUR OR next_entry)
)"""


def _visitor() -> str:
    w = _window("ts", DAY)
    return f"""
WITH {PAGES},{VISITS},{BOUNCES},
lifted AS (
    SELECT ts, vc, ch, ar, is_new, 0 AS uv, 1 AS pv, 0 AS sv, 0 AS uj, during_time AS dur
    FROM pages_log
    UNION ALL SELECT ts, vc, ch, ar, is_new, 1, 0, 0, 0, 0 FROM visits
    UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 1, 0, 0 FROM pages_log
              WHERE last_page_id IS NULL
    UNION ALL SELECT ts, vc, ch, ar, is_new, 0, 0, 0, 1, 0 FROM bounced
),
windowed AS (SELECT *, {w} AS w FROM lifted)
SELECT {_label("w")} AS stt, {_label(f"w + {DAY * 1_000_000}")} AS edt, vc, ch, ar, is_new,
       CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(pv) AS BIGINT) AS pv_ct,
       CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(uj) AS BIGINT) AS uj_ct,
       CAST(sum(dur) AS BIGINT) AS dur_sum
FROM windowed GROUP BY w, vc, ch, ar, is_new"""


PRODUCT_ROWS = f"""{WIDE},{PAYMENT},{_paid('wide')},{PAGES},{DISPLAYS},
lifted AS (
    SELECT ts, item AS sku_id, 'click_ct' AS metric, 1 AS n, NULL AS amount,
           NULL AS kind, NULL AS ref
    FROM pages_log WHERE page_id = 'good_detail'
    UNION ALL SELECT ts, CAST(item AS BIGINT), 'display_ct', 1, NULL, NULL, NULL
    FROM shown WHERE item_type = 'sku_id'
    UNION ALL SELECT ts, event_id % 2000, 'favor_ct', 1, NULL, NULL, NULL
    FROM events WHERE event_type = 'signup'
    UNION ALL SELECT ts, event_id % 2000, 'cart_ct', 1, NULL, NULL, NULL
    FROM events WHERE event_type = 'click'
    UNION ALL SELECT ts, event_id % 2000, 'comment_ct',
           1, NULL, CASE WHEN event_id % 4 = 0 THEN 'good' END, NULL
    FROM events WHERE event_type = 'purchase'
    UNION ALL SELECT ts, event_id % 2000, 'refund', 1, CAST(value AS DECIMAL(16,2)),
           'refund', event_id % 15000
    FROM events WHERE event_type = 'error'
    UNION ALL SELECT rowtime, sku_id, 'order', sku_num, split_total_amount, 'order', order_id
    FROM wide
    UNION ALL SELECT payment_time, sku_id, 'payment', 1, split_total_amount, 'payment',
           order_id
    FROM paid
)"""


def _product(rows: str = PRODUCT_ROWS) -> str:
    w = _window("ts", 30 * DAY)
    count = "CAST(coalesce(sum(CASE WHEN metric = '{0}' THEN n END), 0) AS BIGINT)"
    amount = (
        "CAST(coalesce(sum(CASE WHEN metric = '{0}' THEN amount END), 0) AS DOUBLE)"
    )
    refs = "count(DISTINCT CASE WHEN kind = '{0}' THEN ref END)"
    return f"""
WITH {rows},
windowed AS (SELECT *, {w} AS w FROM lifted),
stats AS (
    SELECT {_label("w")} AS stt, {_label(f"w + {30 * DAY * 1_000_000}")} AS edt, sku_id,
           {count.format('display_ct')} AS display_ct, {count.format('click_ct')} AS click_ct,
           {count.format('favor_ct')} AS favor_ct, {count.format('cart_ct')} AS cart_ct,
           {count.format('order')} AS order_sku_num, {amount.format('order')} AS order_amount,
           {refs.format('order')} AS order_ct,
           {amount.format('payment')} AS payment_amount,
           {refs.format('payment')} AS paid_order_ct,
           {refs.format('refund')} AS refund_order_ct,
           {amount.format('refund')} AS refund_amount,
           {count.format('comment_ct')} AS comment_ct,
           count(CASE WHEN kind = 'good' THEN 1 END) AS good_comment_ct
    FROM windowed GROUP BY w, sku_id
)
SELECT stats.*, sku_name, CAST(sku_price AS DOUBLE) AS sku_price, spu_id, spu_name, tm_id,
       tm_name, category3_id, category3_name
FROM stats LEFT JOIN sku ON stats.sku_id = sku.id"""


def _province(measure: str, zone_hours: int = 0) -> str:
    w = _window("rowtime", DAY)
    zone = f"{zone_hours} * 3600000000"
    return f"""
WITH {WIDE}, windowed AS (SELECT *, {w} AS w FROM wide)
SELECT {_label(f"w + {zone}")} AS stt, {_label(f"w + {DAY * 1_000_000} + {zone}")} AS edt, province_id,
       province_name, province_area_code, province_iso_code, province_3166_2_code,
       count(DISTINCT order_id) AS order_count, CAST(sum({measure}) AS DOUBLE) AS order_amount
FROM windowed
GROUP BY w, province_id, province_name, province_area_code, province_iso_code,
         province_3166_2_code"""


# Runs of letters, marks and digits in any script; the texts hold no Han.
TOKEN = r"[\p{L}\p{M}\p{N}]+"

WORDS = f"""
words AS (
    SELECT unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS keyword,
           TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL '1' SECOND AS rowtime
    FROM documents
)"""


def _keyword() -> str:
    w = _window("rowtime", 10)
    return f"""
WITH {WORDS}, windowed AS (SELECT *, {w} AS w FROM words)
SELECT keyword, count(*) AS ct, 'SEARCH' AS source, {_label("w")} AS stt,
       {_label("w + 10000000")} AS edt
FROM windowed GROUP BY w, keyword"""


CHANGES = """
changes AS (
    SELECT o_orderkey AS k, n.n AS n, o_orderkey * 2 + n.n AS ts,
           CASE o_orderkey % 4 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' ELSE 'insert' END
               AS type,
           o_custkey AS c, o_orderstatus AS s
    FROM orders JOIN (VALUES (0), (1)) AS n(n) ON n.n = 0 OR o_orderkey % 8 = 1
)"""

ORDER_WIDE_COLUMNS = """
    detail_id, order_id, sku_id, CAST(order_price AS DOUBLE) AS order_price, sku_num,
    sku_name, province_id, order_status, user_id,
    CAST(total_amount AS DOUBLE) AS total_amount,
    CAST(split_total_amount AS DOUBLE) AS split_total_amount, create_time, create_date,
    create_hour, province_name, province_area_code, province_iso_code,
    province_3166_2_code, user_age, user_gender, spu_id, tm_id, category3_id, spu_name,
    tm_name, category3_name"""


PAGE_COLUMNS = "event_id, mid, page_id, vc, ch, ar, is_new"

MOVING = """
o AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderkey * 7919 % 1000 + 1 AS place FROM orders),
moved AS (
    SELECT k, 'insert' AS type, s, place AS ts FROM o WHERE k % 5 = 0
    UNION ALL SELECT k, 'update', 'U', place FROM o WHERE k % 5 = 1
    UNION ALL SELECT k, 'update', 'V', place + 1000 FROM o WHERE k % 5 < 2 AND k % 2 = 0
    UNION ALL SELECT k, 'delete', NULL, place FROM o WHERE k % 5 = 2
)"""
# A key's last change left the row that its next one takes out.
RETRACTED = f"""
WITH {MOVING},
followed AS (SELECT *, lag(s) OVER (PARTITION BY k ORDER BY ts) AS old FROM moved)
SELECT ts, false AS is_add, k AS o_orderkey, old AS o_orderstatus FROM followed WHERE old IS NOT NULL
UNION ALL SELECT ts, true, k, s FROM followed WHERE s IS NOT NULL"""

# Two further entry pages within the time make the pattern; its first page is the bounce.
BOUNCE_THREE = f"""
WITH {PAGES},
followed AS (
    SELECT *, last_page_id IS NULL AS entry, ts + INTERVAL '6' HOUR AS until,
           lead(ts, 1) OVER w AS t1, lead(last_page_id IS NULL, 1) OVER w AS e1,
           lead(ts, 2) OVER w AS t2, lead(last_page_id IS NULL, 2) OVER w AS e2
    FROM pages_log WINDOW w AS (PARTITION BY mid ORDER BY ts, event_id)),
judged AS (
    SELECT *, CASE WHEN t1 IS NULL OR t1 >= until THEN 'timeout' WHEN NOT e1 THEN NULL
                   WHEN t2 IS NULL OR t2 >= until THEN 'timeout' WHEN e2 THEN 'matched' END AS reason
    FROM followed WHERE entry)
SELECT {PAGE_COLUMNS}, reason FROM judged WHERE reason IS NOT NULL"""

NEW_VISITORS = f"""
WITH {PAGES}
SELECT event_id, mid, is_new AS was_new,
       CASE WHEN is_new = '1' AND row_number() OVER (
                PARTITION BY mid, is_new ORDER BY ts, event_id) > 1
            THEN '0' ELSE is_new END AS is_new
FROM pages_log"""

ORACLE: dict[str, str] = {
    "order_join": f"""
WITH {JOINED}
SELECT detail_id, order_id, sku_id, CAST(order_price AS DOUBLE) AS order_price, sku_num,
       CAST(split_total_amount AS DOUBLE) AS split_total_amount, province_id,
       order_status, user_id, CAST(total_amount AS DOUBLE) AS total_amount,
       strftime(rowtime, {TIME}) AS create_time
FROM joined""",
    "order_wide": f"WITH {WIDE} SELECT {ORDER_WIDE_COLUMNS} FROM wide",
    "order_wide_stream": f"WITH {WIDE} SELECT {ORDER_WIDE_COLUMNS} FROM wide",
    "interval_join_exclusive": f"""
WITH {ORDER_INFO},{ORDER_DETAIL},{_joined('>', '<')}
SELECT order_id, detail_id, sku_id FROM joined""",
    "interval_join_exclusive_stream": f"""
WITH {ORDER_INFO},{ORDER_DETAIL},{_joined('>', '<')}
SELECT order_id, detail_id, sku_id FROM joined""",
    "line_interval_join": """
WITH l AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS name,
                  epoch_us(o_orderdate) // 1000000 AS ts FROM orders),
     r AS (SELECT CAST(l_orderkey AS VARCHAR) AS id, l_returnflag AS sex,
                  epoch_us(l_shipdate) // 1000000 AS ts FROM lineitem)
SELECT l.id, l.name, r.sex, l.ts AS left_ts, r.ts AS right_ts
FROM l JOIN r ON l.id = r.id AND r.ts > l.ts - 432000 AND r.ts < l.ts + 432000""",
    "payment_wide": f"""
WITH {WIDE},{PAYMENT},{_paid('wide')}
SELECT payment_id, payment_type, strftime(payment_time, {TIME}) AS payment_create_time,
       order_id, user_id, CAST(total_amount AS DOUBLE) AS total_amount, detail_id, sku_id,
       sku_num, CAST(split_total_amount AS DOUBLE) AS split_total_amount, province_name,
       user_age, user_gender, sku_name, spu_name, tm_name, category3_name,
       strftime(order_time, {TIME}) AS order_create_time
FROM paid""",
    "payment_wide_stream": f"""
WITH {WIDE},{PAYMENT},{_paid('wide')}
SELECT payment_id, payment_type, strftime(payment_time, {TIME}) AS payment_create_time,
       order_id, user_id, CAST(total_amount AS DOUBLE) AS total_amount, detail_id, sku_id,
       sku_num, CAST(split_total_amount AS DOUBLE) AS split_total_amount, province_name,
       user_age, user_gender, sku_name, spu_name, tm_name, category3_name,
       strftime(order_time, {TIME}) AS order_create_time
FROM paid""",
    "payment_order_join": f"""
WITH {ORDER_INFO},{PAYMENT}
SELECT p.id AS payment_id, p.payment_type, o.province_id, o.order_status,
       strftime(p.rowtime, {TIME}) AS payment_create_time
FROM payment_info p JOIN order_info o ON p.order_id = o.id
 AND o.rowtime >= p.rowtime - INTERVAL '15' MINUTE AND o.rowtime <= p.rowtime""",
    "order_wide_merge": """
WITH a AS (
    SELECT o_orderkey AS order_id, nullif(o_orderstatus, 'F') AS order_status,
           CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS user_id,
           CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS split_total_amount
    FROM orders),
b AS (
    SELECT o_orderkey AS order_id, concat(o_orderstatus, '2') AS order_status,
           -o_custkey AS user_id, 0.0 AS split_total_amount
    FROM orders WHERE o_orderkey % 5 <> 0)
SELECT a.order_id, coalesce(a.order_status, b.order_status) AS order_status,
       coalesce(a.user_id, b.user_id) AS user_id, a.split_total_amount
FROM a LEFT JOIN b ON a.order_id = b.order_id""",
    "dim_lookup_composite": f"""
WITH {ORDER_DETAIL},
dim AS (
    SELECT p_brand, p_size, min(p_name) AS part_name FROM part GROUP BY p_brand, p_size),
fact AS (
    SELECT d.id AS detail_id, d.order_id, s.p_brand AS brand,
           CASE WHEN d.order_id % 10 = 0 THEN NULL
                WHEN d.order_id % 10 = 1 THEN -1 ELSE s.p_size END AS size
    FROM order_detail d JOIN part s ON d.sku_id = s.p_partkey)
SELECT detail_id, order_id, brand, size, part_name
FROM fact LEFT JOIN dim ON brand = p_brand AND size = p_size""",
    "dim_point_lookup": """
SELECT p_partkey, p_name, p_brand, p_size FROM part
WHERE p_brand = (SELECT min(p_brand) FROM part)
ORDER BY p_partkey LIMIT 1""",
    "sku_dimension": f"""
WITH {SKU}
SELECT id, sku_name, CAST(sku_price AS DOUBLE) AS sku_price, spu_id, spu_name, tm_id,
       tm_name, category3_id, category3_name FROM sku""",
    "unique_visit": f"WITH {PAGES},{VISITS} SELECT {PAGE_COLUMNS} FROM visits",
    "unique_visit_stream": f"""
WITH {PAGES},{VISITS} SELECT mid, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM visits""",
    "bounce_detail": f"WITH {PAGES},{BOUNCES} SELECT {PAGE_COLUMNS}, reason FROM bounced",
    "bounce_detail_stream": f"""
WITH {PAGES},{BOUNCES}
SELECT {PAGE_COLUMNS}, reason FROM bounced""",
    "bounce_three": BOUNCE_THREE,
    "bounce_three_stream": BOUNCE_THREE,
    "new_visitor_repair": NEW_VISITORS,
    "new_visitor_repair_stream": NEW_VISITORS,
    "page_entries": f"""
WITH {PAGES} SELECT event_id, mid, vc, ch, ar, is_new FROM pages_log
WHERE last_page_id IS NULL""",
    "visitor_metric_rows": f"""
WITH {PAGES},{VISITS},{BOUNCES}
SELECT 'page' AS metric, vc, ch, ar, is_new, strftime(ts, {TIME}) AS at,
       0 AS uv_ct, 1 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, during_time AS dur_sum FROM pages_log
UNION ALL SELECT 'visit', vc, ch, ar, is_new, strftime(ts, {TIME}), 1, 0, 0, 0, 0
FROM visits
UNION ALL SELECT 'session', vc, ch, ar, is_new, strftime(ts, {TIME}), 0, 0, 1, 0, 0
FROM pages_log WHERE last_page_id IS NULL
UNION ALL SELECT 'bounce', vc, ch, ar, is_new, strftime(ts, {TIME}), 0, 0, 0, 1, 0
FROM bounced""",
    "visitor_stats": _visitor(),
    "visitor_stats_stream": _visitor(),
    "visitor_stats_refined_stream": _visitor(),
    "product_metric_rows": f"""
WITH {PRODUCT_ROWS}
SELECT strftime(ts, {TIME}) AS at, sku_id,
       CASE WHEN metric = 'display_ct' THEN n END AS display_ct,
       CASE WHEN metric = 'click_ct' THEN n END AS click_ct,
       CASE WHEN metric = 'favor_ct' THEN n END AS favor_ct,
       CASE WHEN metric = 'cart_ct' THEN n END AS cart_ct,
       CASE WHEN metric = 'order' THEN n END AS order_sku_num,
       CASE WHEN metric = 'comment_ct' THEN n END AS comment_ct,
       CASE WHEN metric = 'comment_ct' THEN CASE WHEN kind = 'good' THEN 1 ELSE 0 END END
           AS good_comment_ct,
       CAST(CASE WHEN metric = 'order' THEN amount END AS DOUBLE) AS order_amount,
       CAST(CASE WHEN metric = 'payment' THEN amount END AS DOUBLE) AS payment_amount,
       CAST(CASE WHEN metric = 'refund' THEN amount END AS DOUBLE) AS refund_amount,
       CASE WHEN kind <> 'good' THEN kind END AS ref_kind, ref AS ref_id
FROM lifted""",
    "product_stats": _product(),
    "product_stats_stream": _product(),
    "product_stats_silent_stream": _product(PRODUCT_ROWS.replace("event_type = 'error'", "false")),
    "late_rows_stream": f"""
WITH first AS (
    SELECT max(ts) - INTERVAL '1' SECOND AS seen FROM events WHERE event_id % 3 <> 0),
grouped AS (
    SELECT CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS mid, event_id % 3 = 0 AS second,
           CAST(ts AS DATE) + INTERVAL '1' DAY <= seen AS closed, ts, seen
    FROM events, first),
last AS (SELECT greatest(max(ts) - INTERVAL '1' SECOND, any_value(seen)) AS seen FROM grouped WHERE second)
SELECT strftime(day, '%Y-%m-%d') AS day, mid, count(*) AS n FROM grouped
WHERE NOT (second AND closed) AND day + INTERVAL '1' DAY <= (SELECT seen FROM last) GROUP BY day, mid
UNION ALL
SELECT 'late', NULL, CAST(count(*) AS BIGINT) FROM (SELECT DISTINCT day, mid FROM grouped WHERE second AND closed)""",
    "province_stats": _province("total_amount"),
    "province_stats_sql": _province("total_amount"),
    "province_stats_split": _province("split_total_amount"),
    "province_stats_stream": _province("total_amount"),
    "province_stats_sql_stream": _province("total_amount", zone_hours=8),
    "keyword_stats": _keyword(),
    "keyword_stats_stream": _keyword(),
    "keyword_vocabulary_stats": f"""
WITH RECURSIVE pieces AS (
    SELECT unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS piece,
           TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL '1' SECOND AS rowtime
    FROM documents),
vocabulary AS (SELECT DISTINCT piece AS word FROM pieces WHERE length(piece) BETWEEN 2 AND 4),
counted AS (
    SELECT {_window('rowtime', DAY)} AS w, piece, count(*) AS n FROM pieces GROUP BY 1, 2),
cut AS (
    SELECT piece, 0 AS done, '' AS word FROM (SELECT DISTINCT piece FROM counted)
    UNION ALL
    SELECT piece, done + length(taken), taken FROM (
        SELECT c.piece, c.done, CASE
                   WHEN length(v4.word) = 4 THEN v4.word WHEN length(v3.word) = 3 THEN v3.word
                   WHEN length(v2.word) = 2 THEN v2.word ELSE substr(c.piece, c.done + 1, 1)
               END AS taken
        FROM cut c
        LEFT JOIN vocabulary v4 ON v4.word = substr(c.piece, c.done + 1, 4)
        LEFT JOIN vocabulary v3 ON v3.word = substr(c.piece, c.done + 1, 3)
        LEFT JOIN vocabulary v2 ON v2.word = substr(c.piece, c.done + 1, 2)
        WHERE c.done < length(c.piece)))
SELECT {_label("w")} AS stt, {_label(f"w + {DAY * 1_000_000}")} AS edt, word AS keyword,
       CAST(sum(n) AS BIGINT) AS ct
FROM counted JOIN cut USING (piece) WHERE word <> '' GROUP BY w, word""",
    "keyword_stats_sql": f"""
WITH words AS (
    SELECT unnest(regexp_extract_all(lower(props), '{TOKEN}')) AS keyword, ts
    FROM events WHERE event_type = 'signup'),
windowed AS (SELECT *, {_window('ts', DAY)} AS w FROM words)
SELECT keyword, count(*) AS ct, 'SEARCH' AS source, {_label("w")} AS stt,
       {_label(f"w + {DAY * 1_000_000}")} AS edt
FROM windowed GROUP BY w, keyword""",
    "search_phrases_sql": f"""
SELECT props AS fullword, strftime(ts, {TIME}) AS at FROM events
WHERE event_type = 'signup'""",
    "log_json_split": """
WITH raw AS (
    SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substr(props, 1, 4) ELSE props END
           AS value FROM events)
SELECT event_id, value,
       json_valid(value) AND coalesce(try_cast(json_type(CASE WHEN json_valid(value)
           THEN value END) AS VARCHAR), '') = 'OBJECT' AS is_valid
FROM raw""",
    "log_start_split": """
SELECT event_id, CASE WHEN event_type = 'signup' THEN 'start' ELSE 'page' END AS route
FROM events""",
    "log_display_explode": f"""
WITH {PAGES},{DISPLAYS} SELECT page_id, item, item_type FROM shown""",
    "json_records": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "cdc_route_fact": f"""
WITH {CHANGES}
SELECT type, 'dwd_order_info' AS sink_table, CAST(k AS VARCHAR) AS o_orderkey,
       CASE WHEN n = 1 THEN 'X' ELSE s END AS o_orderstatus
FROM changes WHERE type = 'insert'""",
    "cdc_route_dim": f"""
WITH {CHANGES}
SELECT type, 'dim_order' AS sink_table, CAST(k AS VARCHAR) AS o_orderkey,
       CASE WHEN n = 0 THEN CAST(c AS VARCHAR) END AS o_custkey
FROM changes WHERE type = 'update'""",
    "cdc_fact_topic": f"""
WITH {CHANGES}
SELECT 'dwd_order_info' AS topic,
       concat('{{"o_orderkey":"', k, '","o_orderstatus":"', s, '"}}') AS value
FROM changes WHERE type = 'insert'""",
    "cdc_route_counts": f"""
WITH {CHANGES}
SELECT CASE type WHEN 'insert' THEN 'fact' ELSE 'dim' END AS route, count(*) AS n
FROM changes WHERE type <> 'delete' GROUP BY 1""",
    "cdc_config_in_force": """
SELECT o_orderpriority AS source_table, o_orderstatus AS operate_type,
       concat('sink_', CAST(max(o_orderkey) AS VARCHAR)) AS sink_table
FROM orders GROUP BY 1, 2
HAVING max(o_orderkey) % 7 <> 0""",
    "cdc_current_state": f"""
WITH {CHANGES}, last AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC) AS rn FROM changes)
SELECT k AS o_orderkey, CASE WHEN n = 0 THEN c END AS o_custkey,
       CASE WHEN n = 1 THEN 'X' ELSE s END AS o_orderstatus
FROM last WHERE rn = 1 AND type <> 'delete'""",
    "cdc_table_sql": f"""
WITH {CHANGES}, last AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC) AS rn FROM changes)
SELECT k AS o_orderkey, CASE WHEN n = 0 THEN c END AS o_custkey,
       CASE WHEN n = 1 THEN 'X' ELSE s END AS o_orderstatus
FROM last WHERE rn = 1 AND type <> 'delete'""",
    "cdc_retract_rows": f"""
WITH {CHANGES}
SELECT ts, false AS is_add, k AS o_orderkey, c AS o_custkey, s AS o_orderstatus
FROM changes WHERE type <> 'insert'
UNION ALL
SELECT ts, true, k, CASE WHEN n = 0 THEN c END, CASE WHEN n = 1 THEN 'X' ELSE s END
FROM changes WHERE type <> 'delete'""",
    "cdc_retract_stateful": RETRACTED,
    "cdc_retract_stateful_stream": RETRACTED,
    "cdc_chunked_snapshot": f"""
WITH {MOVING},
high AS (SELECT k, s, place, k // 5000 * 100 % 1500 + 200 AS high FROM o),
later AS (SELECT m.k, count(*) AS n FROM moved m JOIN high USING (k) WHERE m.ts > high GROUP BY m.k),
there AS (  -- the row was in the table when its chunk's high mark was passed
    SELECT k, CASE k % 5 WHEN 0 THEN place <= high WHEN 2 THEN place > high ELSE true END AS here FROM high),
counted AS (SELECT k, CAST(here AS BIGINT) + coalesce(n, 0) AS events FROM there LEFT JOIN later USING (k))
SELECT k AS o_orderkey, events,
       CASE WHEN k % 5 = 2 THEN NULL WHEN k % 5 < 2 AND k % 2 = 0 THEN 'V' WHEN k % 5 = 1 THEN 'U' ELSE s END AS o_orderstatus
FROM counted JOIN o USING (k) WHERE events > 0""",
    "chained_topics_stream": "SELECT event_id, concat('event_', event_type) AS topic FROM events",
    "cdc_envelope": """
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'delete' WHEN 1 THEN 'update' WHEN 2 THEN 'insert'
            ELSE 'read' END AS operation,
       'shop' AS database, 'order_info' AS table_name,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey END AS after_key,
       CASE WHEN o_orderkey % 4 < 2 THEN o_orderkey END AS before_key
FROM orders""",
    "cdc_envelope_text": """
SELECT concat('{"operation":"', CASE o_orderkey % 4 WHEN 0 THEN 'delete' WHEN 1 THEN 'update'
            WHEN 2 THEN 'create' ELSE 'read' END,
       '","data":{"o_orderkey":"', o_orderkey, '"},"database":"shop","table":"order_info"}')
       AS value
FROM orders""",
    "cdc_parse_text": """
SELECT 'shop' AS database, 'order_info' AS table_name,
       CASE o_orderkey % 3 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'delete' END AS type,
       o_orderkey AS ts,
       CASE WHEN o_orderkey % 3 < 2 THEN o_orderkey END AS after_key,
       CASE WHEN o_orderkey % 3 < 2 THEN o_orderstatus END AS after_status,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey END AS before_key
FROM orders""",
    "cdc_snapshot_and_changes": """
SELECT 'insert' AS type, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       o_orderstatus AS o_orderstatus FROM orders
UNION ALL
SELECT 'update', CAST(o_orderkey AS VARCHAR), 'X' FROM orders WHERE o_orderkey % 4 = 1""",
    "dim_upsert": f"""
WITH {CHANGES}, last AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts DESC) AS rn
    FROM changes WHERE type <> 'delete')
SELECT CAST(k AS VARCHAR) AS o_orderkey, CAST(c AS VARCHAR) AS o_custkey,
       CASE WHEN n = 1 THEN 'X' ELSE s END AS o_orderstatus
FROM last WHERE rn = 1""",
    "hot_user_lookup": f"""
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 2 = 0 THEN 7 ELSE o_custkey END AS user_id,
       CASE WHEN c_custkey % 2 = 0 THEN 'M' WHEN c_custkey IS NOT NULL THEN 'F' END AS user_gender,
       CAST(floor((epoch_ms({AS_OF}) - epoch_ms(CAST(DATE '1960-01-01'
            + CAST(c_custkey % 14000 AS INT) AS TIMESTAMP))) / 31536000000.0) AS INTEGER) AS user_age
FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_orderkey % 2 = 0 THEN 7 ELSE o_custkey END""",
    "dim_written_then_read": f"""
WITH {CHANGES}, named AS (
    -- a second change names its status only; batches apply in the order of ts modulo 3
    SELECT k, ts, ts % 3 AS batch, CASE WHEN n = 0 THEN c END AS c, n, CASE WHEN n = 1 THEN 'X' ELSE s END AS s
    FROM changes WHERE type <> 'delete')
SELECT CAST(k AS VARCHAR) AS o_orderkey, CAST(max(c) AS VARCHAR) AS o_custkey,
       arg_max(s, batch * 1000000000 + ts) AS o_orderstatus
FROM named WHERE k IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1) GROUP BY k""",
    "time_functions": f"""
SELECT o_orderkey, epoch_ms(o_orderdate) - 28800000 AS ms_plus8,
       strftime(o_orderdate, {TIME}) AS as_text,
       epoch_ms(o_orderdate) AS parsed_ms,
       strftime(o_orderdate, '%Y-%m-%d') AS create_date,
       strftime(o_orderdate, '%H') AS create_hour,
       strftime(o_orderdate + INTERVAL '8' HOUR, '%Y-%m-%d') AS day_plus8,
       CASE WHEN o_orderkey % 2 = 0 THEN epoch_ms(o_orderdate) END AS lenient_ms
FROM orders""",
    "event_second": f"""
SELECT event_id, epoch_us(ts) // 1000 AS ms, strftime(ts, {TIME}) AS second FROM events""",
    "user_age": f"""
SELECT c_custkey,
       CAST(floor((epoch_ms({AS_OF}) - epoch_ms(CAST(DATE '1960-01-01'
            + CAST(c_custkey % 14000 AS INT) AS TIMESTAMP))) / 31536000000.0) AS INTEGER)
       AS user_age
FROM customer""",
    "text_functions": """
SELECT p_partkey, lower(p_brand) AS lower_brand, upper(p_type) AS upper_type,
       concat_ws('-', p_brand, p_type) AS joined_name,
       split_part(p_name, ' ', 1) AS first_word,
       p_size % 5 = 0 OR p_size % 5 = 1 AS blank,
       p_size % 5 = 0 AS same_as_null,
       coalesce(CASE WHEN p_size % 2 = 0 THEN p_brand END, p_type) AS first_non_null
FROM part""",
}
