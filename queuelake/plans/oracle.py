"""The registered queries as plain SQL over the flat tables, for DuckDB."""

from __future__ import annotations

_V5 = """v5 AS (
  SELECT event_id AS seq, concat('ent-', user_id) AS id, concat('Ride ', user_id) AS name,
    CASE user_id % 4 WHEN 0 THEN 'ATTRACTION' WHEN 1 THEN 'RESTAURANT' WHEN 2 THEN 'HOTEL' ELSE 'SHOW' END AS entity_type,
    CASE event_type WHEN 'purchase' THEN 'DOWN' WHEN 'signup' THEN 'CLOSED' WHEN 'error' THEN 'REFURBISHMENT'
      ELSE 'OPERATING' END AS status,
    ts AS last_updated, value, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events)"""

_V3 = """v3 AS (
  SELECT c_custkey AS ord, concat('ent-', c_custkey) AS id, c_name AS name, c_nationkey,
    CASE c_custkey % 4 WHEN 0 THEN 'ATTRACTION' WHEN 1 THEN 'RESTAURANT' WHEN 2 THEN 'HOTEL' ELSE 'SHOW' END AS entity_type,
    concat('park-', c_nationkey) AS parent_id,
    CASE WHEN c_custkey % 11 <> 0 AND c_custkey % 7 <> 0 THEN c_acctbal / 128 END AS latitude,
    CASE WHEN c_custkey % 11 <> 0 THEN c_acctbal / 64 - 90 END AS longitude
  FROM customer)"""

_V7 = """v7 AS (
  SELECT o_orderkey AS seq, o_custkey, concat('ent-', o_custkey) AS entity_id,
    strftime(o_orderdate, '%Y-%m-%d') AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(month(o_orderdate) AS INTEGER) AS month,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'OPERATING' WHEN '2' THEN 'TICKETED_EVENT'
      WHEN '3' THEN 'PRIVATE_EVENT' WHEN '4' THEN 'EXTRA_HOURS' ELSE 'INFO' END AS type,
    o_orderdate + INTERVAL 9 HOUR AS opening_time, o_orderdate + INTERVAL 21 HOUR AS closing_time
  FROM orders)"""

_V9 = f"""{_V5}, v9 AS (
  SELECT seq, CAST(floor(seq / 4) AS BIGINT) AS request_id, CAST(seq % 4 AS INTEGER) AS attempt,
    concat('/entity/', id) AS url, last_updated AS received_at,
    CASE WHEN k % 10 = 0 THEN 429 WHEN k % 10 = 1 THEN 502 WHEN k % 10 = 2 THEN 404
      WHEN k % 10 IN (3, 4) THEN NULL ELSE 200 END AS status,
    CASE WHEN k % 10 = 0 THEN 'Too Many Requests' WHEN k % 10 = 1 THEN 'Bad Gateway' WHEN k % 10 = 2 THEN 'Not Found'
      WHEN k % 10 IN (3, 4) THEN NULL ELSE 'OK' END AS reason,
    CASE WHEN k % 10 = 3 THEN 'timeout' WHEN k % 10 = 4 THEN 'network' END AS failure,
    CASE WHEN k % 40 = 0 THEN '3' WHEN k % 40 = 10 THEN '-2' WHEN k % 40 = 20 THEN 'whenever suits'
      WHEN k % 40 = 30 THEN strftime(last_updated + INTERVAL 90 SECOND, '%a, %d %b %Y %H:%M:%S GMT') END AS retry_after,
    CASE k % 3 WHEN 0 THEN 'application/json' WHEN 1 THEN 'text/plain' ELSE 'application/json; charset=utf-8' END AS content_type,
    CASE k % 3 WHEN 0 THEN '{{"error":"no such ride"}}' WHEN 1 THEN repeat('x', 150 + k) ELSE '' END AS body
  FROM v5)"""

_V10 = f"""{_V5}, v10 AS (
  SELECT seq, last_updated AS moment, seq % 2 = 0 AS stored, k % 5 AS kind,
    CASE k % 5 WHEN 0 THEN '/destinations' WHEN 1 THEN concat('/entity/', id)
      WHEN 2 THEN concat('/entity/', id, '/children') WHEN 3 THEN concat('/entity/', id, '/schedule/2024/01')
      ELSE concat('/entity/', id, '/live') END AS path,
    CASE WHEN k % 5 > 0 THEN id END AS entity_id,
    CASE k % 5 WHEN 3 THEN 300 WHEN 4 THEN 0 ELSE 3600 END AS ttl
  FROM v5)"""

# All events as landed responses, with what their bodies say.
_V10L = f"""{_V10}, v10l AS (SELECT v10.seq, moment, path, v5.id, v5.status FROM v10 JOIN v5 USING (seq))"""

_V11 = """v11a AS (SELECT p_partkey AS ord, lower(p_brand) AS slug, p_name AS name FROM part),
labels AS (
  SELECT *, regexp_replace(lower(slug), '[^\\p{L}\\p{N}]', '', 'g') AS ns,
    regexp_replace(lower(name), '[^\\p{L}\\p{N}]', '', 'g') AS nn FROM v11a)"""

_V13 = """v13 AS (
  SELECT c_custkey AS req_id, concat('ent-', c_custkey) AS entity_id,
    CASE WHEN c_custkey % 9 = 0 THEN '1999-01-01' ELSE '1996-12-30' END AS start_date, '1997-11-05' AS end_date
  FROM customer),
asked AS (
  SELECT req_id, entity_id, unnest(CASE WHEN end_date >= start_date THEN
    generate_series(date_trunc('month', CAST(start_date AS TIMESTAMP)), date_trunc('month', CAST(end_date AS TIMESTAMP)), INTERVAL 1 MONTH)
    ELSE [] END) AS m
  FROM v13)"""

_T = "'%Y-%m-%d %H:%M:%S.%f'"

# Same shape as the unpivot: one row per variant that is there.
_OFFERS = f"""{_V5}, offers AS (
  SELECT seq, id, 1 AS variant_ord, 'STANDBY' AS type, CASE WHEN k % 10 <> 0 THEN value END AS wait_time,
    CAST(NULL AS VARCHAR) AS state, CAST(NULL AS TIMESTAMP) AS slot, CAST(NULL AS DOUBLE) AS price_amount,
    CAST(NULL AS VARCHAR) AS price_formatted, CAST(NULL AS VARCHAR) AS allocation_status,
    CAST(NULL AS DOUBLE) AS group_start, CAST(NULL AS DOUBLE) AS estimated_wait, k FROM v5 WHERE k % 2 = 0
  UNION ALL SELECT seq, id, 2, 'SINGLE_RIDER', value / 2, NULL, NULL, NULL, NULL, NULL, NULL, NULL, k FROM v5 WHERE k % 3 = 0
  UNION ALL SELECT seq, id, 3, 'RETURN_TIME', NULL,
    CASE WHEN k % 4 = 0 THEN 'AVAILABLE' WHEN k % 4 = 1 THEN 'TEMP_FULL' WHEN k % 4 = 2 THEN 'FINISHED' END,
    last_updated, NULL, NULL, NULL, NULL, NULL, k FROM v5 WHERE k % 5 = 0
  UNION ALL SELECT seq, id, 4, 'PAID_RETURN_TIME', NULL, 'AVAILABLE', last_updated, CASE WHEN k % 3 <> 0 THEN value END,
    CASE WHEN k % 3 <> 0 AND k % 2 = 0 THEN concat('$', k) END, NULL, NULL, NULL, k FROM v5 WHERE k % 7 = 0
  UNION ALL SELECT seq, id, 5, 'BOARDING_GROUP', NULL, NULL, last_updated, NULL, NULL,
    CASE WHEN k % 2 = 0 THEN 'AVAILABLE' ELSE 'PAUSED' END, CAST(k AS DOUBLE), CASE WHEN k % 3 = 0 THEN value END, k
    FROM v5 WHERE k % 11 = 0
  UNION ALL SELECT seq, id, 6, 'PAID_STANDBY', value / 4, NULL, NULL, NULL, NULL, NULL, NULL, NULL, k FROM v5 WHERE k % 13 = 0)"""

_STANDBY = "CASE WHEN k % 2 = 0 AND k % 10 <> 0 THEN CAST(trunc(value) AS BIGINT) END"

_MESSAGE = """CASE WHEN k3 = 0 THEN left(concat(status, ' ', reason, ': no such ride'), 300)
    WHEN body = '' OR k3 = 2 THEN concat(status, ' ', reason)
    WHEN length(body) > 200 THEN concat(status, ' ', reason, ': ', left(body, 200), '...')
    ELSE concat(status, ' ', reason, ': ', body) END"""

_K3 = "CASE content_type WHEN 'application/json' THEN 0 WHEN 'text/plain' THEN 1 ELSE 2 END"

_HINT = """CASE retry_after WHEN '3' THEN CAST(3 AS DOUBLE) WHEN '-2' THEN CAST(0 AS DOUBLE)
    ELSE (epoch_us(try_strptime(retry_after, '%a, %d %b %Y %H:%M:%S GMT')) - epoch_us(received_at)) / 1e6 END"""

_OUTCOME = """CASE WHEN failure = 'timeout' THEN 'timeout' WHEN failure = 'network' THEN 'network'
    WHEN status BETWEEN 200 AND 299 THEN 'ok' WHEN status = 429 THEN 'rate_limited'
    WHEN status >= 500 THEN 'server_error' ELSE 'api_error' END"""

_RETRYABLE = f"({_OUTCOME} IN ('network', 'server_error', 'rate_limited') AND attempt < 3)"
_LOW = "least(5.0::DOUBLE, 0.25::DOUBLE * pow(2, attempt))"
_HIGH = "least(5.0::DOUBLE, 0.25::DOUBLE * pow(2, attempt) * 1.25::DOUBLE)"

_FINAL = f"""{_V9}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY attempt DESC) AS rn,
    count(*) OVER (PARTITION BY request_id) AS attempts FROM v9)"""

_NEWEST_LIVE = f"""{_V5}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY last_updated DESC, seq DESC) AS rn FROM v5)"""


def _fault(rule: str, remainder: int, field: str) -> str:
    return f"WITH {_V5} SELECT seq, '{rule}' AS rule, '{field}' AS field FROM v5 WHERE k % 12 = {remainder}"


_HOURS = f"""SELECT seq, entity_id, 0 AS ord, type, strftime(opening_time, {_T}) AS start_time,
  CASE WHEN seq % 5 <> 0 THEN strftime(closing_time, {_T}) END AS end_time FROM v7"""

_BOARD = f"""SELECT id, name, status, {_STANDBY} AS wait, strftime(last_updated, {_T}) AS last_updated, seq
  FROM ranked WHERE rn = 1"""

ORACLE: dict[str, str] = {
    "q01_destinations": """SELECT r_regionkey AS ord, concat('dest-', r_regionkey) AS id, concat(r_name, ' Resort') AS name,
        lower(replace(r_name, ' ', '-')) AS slug, CASE WHEN r_regionkey % 2 = 0 THEN concat('x', r_regionkey) END AS external_id
        FROM region""",
    "q02_entities": f"""WITH {_V3} SELECT ord AS seq, id, name, entity_type, parent_id,
        concat('dest-', n_regionkey) AS destination_id,
        CASE n_regionkey WHEN 0 THEN 'Africa/Johannesburg' WHEN 1 THEN 'America/New_York' WHEN 2 THEN 'Asia/Tokyo'
          WHEN 3 THEN 'Europe/Paris' ELSE 'Asia/Dubai' END AS timezone, latitude, longitude
        FROM v3 JOIN nation ON c_nationkey = n_nationkey""",
    "q03_walk": f"""WITH {_V3} SELECT parent_id AS root_id, ord // 1024 AS seq,
        CAST(row_number() OVER (PARTITION BY c_nationkey, ord // 1024 ORDER BY ord) - 1 AS INTEGER) AS ord,
        id, name, entity_type, parent_id FROM v3""",
    "q04_live_rows": f"""WITH {_V5} SELECT seq, 0 AS ord, id, name, entity_type, status,
        strftime(last_updated, {_T}) AS last_updated FROM v5""",
    "q05_upcoming_schedule": f"""WITH {_V7} SELECT seq, 0 AS ord, entity_id, date, type,
        strftime(opening_time, {_T}) AS opening_time, strftime(closing_time, {_T}) AS closing_time FROM v7""",
    "q06_month_page": f"""WITH {_V7} SELECT seq, entity_id, year, month, date, type FROM v7
        WHERE year = 1997 AND month = 3""",
    "q07_routes": f"""WITH {_V10} SELECT seq, path,
        CASE kind WHEN 0 THEN 'destinations' WHEN 1 THEN 'entity' WHEN 2 THEN 'children' WHEN 3 THEN 'schedule' ELSE 'live' END AS endpoint,
        entity_id, CASE WHEN kind = 3 THEN 2024 END AS year, CASE WHEN kind = 3 THEN 1 END AS month FROM v10""",
    "q08_encoded_paths": "SELECT page_id, concat('/entity/', url_encode(url)) AS path FROM pages",
    "q10_rejects_unreadable": _fault("VAL1", 0, "body"),
    "q11_rejects_required": _fault("VAL2", 1, "liveData.name"),
    "q12_rejects_domain": _fault("VAL3", 2, "liveData.status"),
    "q13_rejects_naive_instant": _fault("VAL4", 3, "liveData.lastUpdated"),
    "q14_null_waits_accepted": f"WITH {_V5} SELECT seq, id FROM v5 WHERE k % 12 = 5",
    "q15_accepted_waits": f"""WITH {_V5} SELECT seq, id, CASE WHEN k % 12 = 4 THEN CAST(30 AS DOUBLE) ELSE value END AS wait_time
        FROM v5 WHERE k % 12 = 4 OR k % 12 > 5""",
    "q16_tags": f"""WITH {_V5} SELECT seq, id AS entity_id, concat('tag', k % 4) AS tag,
        CASE k % 3 WHEN 0 THEN 'STRING' WHEN 1 THEN 'NUMBER' ELSE 'OBJECT' END AS value_kind,
        CAST(k AS VARCHAR) AS value_text FROM v5 WHERE k % 5 < 3""",
    "q20_destination_parks": """SELECT concat('dest-', n_regionkey) AS destination_id,
        CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INTEGER) AS park_ord,
        concat('park-', n_nationkey) AS park_id, n_name AS park_name FROM nation""",
    "q21_queue_offers": f"""WITH {_OFFERS} SELECT seq, variant_ord, type, wait_time, state,
        CASE WHEN variant_ord IN (3, 4) THEN strftime(slot, {_T}) END AS return_start,
        CASE WHEN variant_ord IN (3, 4) THEN strftime(slot + INTERVAL 1 HOUR, {_T}) END AS return_end,
        price_amount, CASE WHEN price_amount IS NOT NULL THEN 'USD' END AS price_currency, price_formatted,
        allocation_status, group_start, group_start + 10 AS group_end,
        CASE WHEN variant_ord = 5 THEN strftime(slot + INTERVAL 1 HOUR, {_T}) END AS next_allocation_time, estimated_wait
        FROM offers""",
    "q22_queue_wide": f"""WITH {_V5} SELECT seq, id,
        CASE WHEN k % 2 = 0 AND k % 10 <> 0 THEN value END AS standby_wait,
        CASE WHEN k % 3 = 0 THEN value / 2 END AS single_rider_wait,
        CASE WHEN k % 13 = 0 THEN value / 4 END AS paid_standby_wait,
        k % 5 = 0 AS has_return_time,
        CASE WHEN k % 5 = 0 THEN CASE k % 4 WHEN 0 THEN 'AVAILABLE' WHEN 1 THEN 'TEMP_FULL' WHEN 2 THEN 'FINISHED' END END AS return_state,
        k % 7 = 0 AS has_paid_return_time, CASE WHEN k % 7 = 0 THEN 'AVAILABLE' END AS paid_return_state,
        k % 11 = 0 AS has_boarding_group,
        CASE WHEN k % 11 = 0 THEN CASE WHEN k % 2 = 0 THEN 'AVAILABLE' ELSE 'PAUSED' END END AS allocation_status,
        CASE WHEN k % 11 = 0 THEN CAST(k AS DOUBLE) END AS group_start,
        CASE WHEN k % 11 = 0 THEN CAST(k + 10 AS DOUBLE) END AS group_end,
        CASE WHEN k % 11 = 0 AND k % 3 = 0 THEN value END AS estimated_wait FROM v5""",
    "q23_price_labels": f"""WITH {_OFFERS} SELECT seq, id, CASE WHEN k % 3 = 0 THEN '?' ELSE price_formatted END AS price_label
        FROM offers WHERE type = 'PAID_RETURN_TIME'""",
    "q24_showtimes": f"WITH {_V7} {_HOURS} WHERE seq % 2 = 0",
    "q25_operating_hours": f"WITH {_V7} {_HOURS} WHERE seq % 2 = 1",
    "q26_dining": f"""WITH {_V5} SELECT seq, id AS entity_id, 0 AS ord,
        CASE WHEN k % 9 <> 0 THEN CAST(k % 8 + 1 AS DOUBLE) END AS party_size, CASE WHEN k % 4 <> 0 THEN value END AS wait_time
        FROM v5 WHERE k % 3 = 1""",
    "q27_purchases": """SELECT l_orderkey AS seq, concat('ent-', l_orderkey) AS entity_id, strftime(l_shipdate, '%Y-%m-%d') AS date,
        CASE l_returnflag WHEN 'A' THEN 'ADMISSION' WHEN 'N' THEN 'PACKAGE' ELSE 'ATTRACTION' END AS type,
        concat(l_linenumber, '-', l_partkey, '-', l_suppkey) AS purchase_id, CAST(l_quantity AS VARCHAR) AS purchase_name,
        l_extendedprice AS amount, 'USD' AS currency, l_linestatus = 'O' AS available FROM lineitem""",
    "q28_destination_schedule": f"""WITH {_V7} SELECT concat('dest-', n_regionkey) AS root_id,
        CASE WHEN seq % 10 = 0 THEN concat('dest-', n_regionkey) ELSE concat('park-', n_nationkey) END AS owner_id, seq, date, type
        FROM v7 JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "q29_locations": f"WITH {_V3} SELECT id, latitude, longitude FROM v3",
    "q30_find_one": f"""WITH {_V11} SELECT ord, slug, name FROM labels
        WHERE contains(ns, 'bluering') OR contains(nn, 'bluering') ORDER BY ord LIMIT 1""",
    "q31_find_many": f"""WITH {_V11}, v11b AS (
        SELECT DISTINCT upper(replace(p_name, ' ', '-')) AS q FROM part
        UNION ALL SELECT 'Brand 12' UNION ALL SELECT 'ring' UNION ALL SELECT 'nowhere' UNION ALL SELECT '  ' UNION ALL SELECT '!?'),
        needles AS (SELECT q, regexp_replace(lower(q), '[^\\p{{L}}\\p{{N}}]', '', 'g') AS n FROM v11b),
        firsts AS (SELECT n, min(ord) AS ord FROM (SELECT DISTINCT n FROM needles WHERE n <> '') JOIN labels
          ON contains(ns, n) OR contains(nn, n) GROUP BY n)
        SELECT q, f.ord, l.slug, l.name FROM needles LEFT JOIN firsts f USING (n) LEFT JOIN labels l ON l.ord = f.ord""",
    "q32_longest_waits": f"""WITH {_V5} SELECT seq, 0 AS ord, id, name, status, {_STANDBY} AS wait FROM v5
        WHERE {_STANDBY} IS NOT NULL ORDER BY wait DESC, seq""",
    "q33_located_by_type": f"""WITH {_V3} SELECT entity_type, count(*) AS entities FROM v3
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY entity_type""",
    "q34_ticketed_events": f"WITH {_V7} SELECT seq, entity_id, date, type FROM v7 WHERE type = 'TICKETED_EVENT'",
    "q35_reported_offers": f"""WITH {_OFFERS} SELECT seq, id, variant_ord, type, wait_time FROM offers
        WHERE type NOT IN ('STANDBY', 'SINGLE_RIDER', 'PAID_STANDBY') OR wait_time IS NOT NULL""",
    "q36_located_listing": f"""WITH {_V3} SELECT entity_type, name, latitude, longitude FROM v3
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL ORDER BY ALL""",
    "q37_live_board": f"""WITH {_V5} SELECT seq, 0 AS ord, id, name, status, {_STANDBY} AS wait FROM v5 ORDER BY name, seq""",
    "q40_schedule_range": f"""WITH {_V7} SELECT entity_id, date, year, month, seq, type FROM v7
        WHERE date BETWEEN '1996-12-30' AND '1997-11-05' ORDER BY date, seq""",
    "q41_schedule_ranges": f"""WITH {_V7}, {_V13} SELECT req_id, entity_id, seq, date, type FROM v13 JOIN v7 USING (entity_id)
        WHERE date BETWEEN start_date AND end_date""",
    "q42_descendants": """WITH RECURSIVE e AS (
        SELECT concat('park-', n_nationkey) AS id, concat('dest-', n_regionkey) AS parent_id FROM nation
        UNION ALL SELECT concat('ent-', c_custkey), concat('park-', c_nationkey) FROM customer),
        walk AS (SELECT parent_id AS root_id, id, 1 AS depth FROM e
        UNION ALL SELECT w.root_id, e.id, w.depth + 1 FROM walk w JOIN e ON e.parent_id = w.id)
        SELECT root_id, id, depth FROM walk""",
    "q43_fresh_hits": f"""WITH {_V10}, kept AS (
        SELECT path, moment, max(seq) AS seq FROM v10 WHERE stored AND ttl > 0 GROUP BY path, moment),
        timeline AS (SELECT r.seq, r.path, r.moment, r.ttl, s.seq AS s_seq, s.moment AS s_at
          FROM (SELECT * FROM v10 WHERE NOT stored) r ASOF LEFT JOIN kept s ON r.path = s.path AND r.moment >= s.moment)
        SELECT seq, path, CASE WHEN moment < s_at + to_seconds(ttl) THEN s_seq END AS stored_seq,
        CASE WHEN moment < s_at + to_seconds(ttl) THEN strftime(s_at, {_T}) END AS stored_at FROM timeline""",
    "q44_range_counts": f"""WITH {_V7}, {_V13} SELECT req_id, count(seq) AS entries FROM v13 LEFT JOIN v7
        ON v7.entity_id = v13.entity_id AND date BETWEEN start_date AND end_date GROUP BY req_id""",
    "q45_newest_stored": f"""WITH {_V10}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY path ORDER BY moment DESC, seq DESC) AS rn FROM v10 WHERE stored)
        SELECT path, seq, strftime(moment, {_T}) AS fetched_at, '{{}}' AS body FROM ranked WHERE rn = 1""",
    "q46_newest_payload": f"""WITH {_V10L}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY path ORDER BY moment DESC, seq DESC) AS rn FROM v10l)
        SELECT path, seq, strftime(moment, {_T}) AS fetched_at,
        concat('{{"poll":', seq, ',"id":"', id, '","status":"', status, '"}}') AS body FROM ranked WHERE rn = 1""",
    "q50_normalized_text": "SELECT doc_id, regexp_replace(lower(text), '[^\\p{L}\\p{N}]', '', 'g') AS normalized FROM documents",
    "q51_current_waits": f"WITH {_V5} SELECT seq, id, {_STANDBY} AS wait FROM v5",
    "q52_instants": f"""WITH d AS (SELECT o_orderkey AS ord, o_orderkey % 4 AS form, strftime(o_orderdate, '%Y-%m-%d') AS day,
          o_orderdate + INTERVAL 9 HOUR AS clock,
          CASE o_custkey % 3 WHEN 0 THEN 'America/New_York' WHEN 1 THEN 'Asia/Tokyo' ELSE 'Europe/Paris' END AS tz FROM orders)
        SELECT ord, concat(day, CASE form WHEN 0 THEN 'T09:00:00-04:00' WHEN 1 THEN 'T09:00:00Z' WHEN 2 THEN 'T09:00:00' ELSE ' bad' END) AS v,
        tz, strftime(CASE form WHEN 0 THEN clock + INTERVAL 4 HOUR WHEN 1 THEN clock
          WHEN 2 THEN (clock AT TIME ZONE tz) AT TIME ZONE 'UTC' END, {_T}) AS instant FROM d""",
    "q53_bad_dates": """SELECT o_orderkey AS ord, concat('invalid date: ', strftime(o_orderdate, '%Y-%m-%d'), ' bad') AS error
        FROM orders WHERE o_orderkey % 4 = 3""",
    "q54_request_months": f"""WITH {_V13} SELECT req_id, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month FROM asked""",
    "q55_month_paths": f"""WITH {_V13} SELECT req_id, concat('/entity/', entity_id, '/schedule/', year(m), '/', lpad(CAST(month(m) AS VARCHAR), 2, '0')) AS path
        FROM asked""",
    "q56_freshness_limits": f"WITH {_V10} SELECT seq, path, ttl FROM v10",
    "q57_retry_after": f"WITH {_V9} SELECT seq, retry_after, {_HINT} AS seconds FROM v9",
    "q58_backoff_bounds": f"WITH {_V9} SELECT seq, attempt, {_LOW} AS low, {_HIGH} AS high FROM v9",
    "q59_error_messages": f"""WITH {_V9}, m AS (SELECT *, {_K3} AS k3 FROM v9 WHERE status >= 300)
        SELECT seq, {_MESSAGE} AS message FROM m""",
    "q60_json_bodies": f"WITH {_V9} SELECT seq, content_type, contains(content_type, 'application/json') AS is_json FROM v9",
    "q61_manifest": f"""WITH {_V13} SELECT DISTINCT concat('/entity/', entity_id, '/schedule/', year(m), '/', lpad(CAST(month(m) AS VARCHAR), 2, '0')) AS path
        FROM asked""",
    "q62_to_fetch": f"""WITH {_V10} SELECT DISTINCT path FROM v10 r WHERE NOT stored AND NOT EXISTS (
        SELECT 1 FROM v10 s WHERE s.stored AND s.path = r.path AND s.moment <= TIMESTAMP '2024-01-30 23:00:00'
          AND TIMESTAMP '2024-01-30 23:00:00' < s.moment + to_seconds(s.ttl))""",
    "q63_attempt_outcomes": f"WITH {_V9} SELECT seq, {_OUTCOME} AS outcome FROM v9",
    "q64_retryable": f"WITH {_V9} SELECT seq, attempt, {_RETRYABLE} AS retryable FROM v9",
    "q65_retry_waits": f"""WITH {_V9} SELECT seq, {_RETRYABLE} AS retryable,
        CASE WHEN {_RETRYABLE} THEN coalesce({_HINT}, {_LOW}) END AS wait_low,
        CASE WHEN {_RETRYABLE} THEN coalesce({_HINT}, {_HIGH}) END AS wait_high FROM v9""",
    "q66_final_outcomes": f"""WITH {_FINAL} SELECT request_id, attempts, attempt, status, {_OUTCOME} AS outcome
        FROM ranked WHERE rn = 1""",
    "q67_dead_letters": f"""WITH {_FINAL}, m AS (SELECT *, {_K3} AS k3, {_OUTCOME} AS outcome FROM ranked WHERE rn = 1)
        SELECT request_id, attempts, outcome, status, url, CASE outcome WHEN 'timeout' THEN concat('request to ', url, ' timed out')
          WHEN 'network' THEN concat('network error calling ', url) ELSE {_MESSAGE} END AS message,
        CASE WHEN outcome = 'rate_limited' THEN {_HINT} END AS retry_after_seconds FROM m WHERE outcome <> 'ok'""",
    "q70_current_board": f"WITH {_NEWEST_LIVE} {_BOARD}",
    "q71_current_longest_waits": f"""WITH {_NEWEST_LIVE} SELECT id, name, status, {_STANDBY} AS wait FROM ranked
        WHERE rn = 1 AND {_STANDBY} IS NOT NULL""",
    "q72_stream_offers": f"WITH {_OFFERS} SELECT seq, id, variant_ord, type, wait_time FROM offers",
    "q73_stream_first_sightings": f"""WITH {_V5} SELECT DISTINCT id, name, strftime(last_updated, {_T}) AS last_updated FROM v5""",
    "q74_stream_board": f"WITH {_NEWEST_LIVE} {_BOARD}",
}

ORACLE["q80_stored_month_page"] = ORACLE["q06_month_page"]
ORACLE["q81_stored_offers"] = ORACLE["q21_queue_offers"]
ORACLE["q82_stored_rejects"] = " UNION ALL ".join(
    f"SELECT seq, rule, field FROM ({ORACLE[name]})"
    for name in ("q10_rejects_unreadable", "q11_rejects_required", "q12_rejects_domain", "q13_rejects_naive_instant")
)
ORACLE["q83_stream_silver"] = ORACLE["q72_stream_offers"]
ORACLE["q84_delivery_counts"] = f"""WITH {_V5}, d AS (SELECT CASE WHEN seq % 100 = 1 THEN 'unrouted' ELSE 'live' END AS kind, k FROM v5)
    SELECT 'all' AS delivery, kind, count(*) FILTER (kind = 'live' AND k % 12 > 3) AS accepted,
    count(*) FILTER (kind = 'unrouted' OR k % 12 <= 3) AS rejected FROM d GROUP BY kind"""
ORACLE["q85_reject_counts"] = f"""SELECT 'all' AS delivery, 'live' AS kind, rule, field, count(*) AS rejects
    FROM ({ORACLE["q82_stored_rejects"]}) GROUP BY rule, field"""
ORACLE["q86_stored_deep_schedule"] = f"""WITH {_V7} SELECT seq, concat('dest-', o_custkey) AS root_id, CAST(seq % 4 AS INTEGER) AS depth,
    concat(CASE seq % 4 WHEN 0 THEN 'dest-' WHEN 1 THEN 'land-' WHEN 2 THEN 'park-' ELSE 'area-' END, o_custkey) AS owner_id,
    date, type FROM v7 WHERE seq % 11 <> 0"""
ORACLE["q87_stored_live_day"] = f"""WITH {_V5} SELECT seq, id, status, {_STANDBY} AS wait FROM v5
    WHERE CAST(last_updated AS DATE) = DATE '2024-01-15'"""
ORACLE["q88_stored_nested_tables"] = f"""WITH {_V7}, {_V5}, p AS ({ORACLE["q27_purchases"]})
    SELECT CASE seq % 2 WHEN 0 THEN 'showtimes' ELSE 'operating_hours' END AS "table", seq, entity_id, strftime(opening_time, {_T}) AS what FROM v7
    UNION ALL SELECT 'dining', seq, id, CASE WHEN k % 9 <> 0 THEN CAST(k % 8 + 1 AS VARCHAR) END FROM v5 WHERE k % 3 = 1
    UNION ALL SELECT 'tags', seq, id, concat('tag', k % 4, CASE k % 3 WHEN 0 THEN ' STRING' WHEN 1 THEN ' NUMBER' ELSE ' OBJECT' END) FROM v5 WHERE k % 5 < 3
    UNION ALL SELECT 'purchases', seq, entity_id, purchase_id FROM p"""
ORACLE["q89_entity_upcoming"] = """WITH ranked AS (
    SELECT l_orderkey AS seq, concat('ent-', l_orderkey) AS entity_id, strftime(l_shipdate, '%Y-%m-%d') AS date,
      CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
      max(l_shipdate) OVER (PARTITION BY year(l_shipdate), month(l_shipdate)) AS newest, l_shipdate
    FROM lineitem WHERE l_orderkey = 7)
    SELECT seq, entity_id, date, year, month FROM ranked WHERE l_shipdate = newest"""
ORACLE["q90_listed_destinations"] = """SELECT p_partkey // 1024 AS seq, p_brand AS id, concat(p_brand, ' Resort') AS name,
    lower(replace(p_brand, '#', '-')) AS slug, CAST(count(*) AS INTEGER) AS parks,
    CAST(row_number() OVER (PARTITION BY p_partkey // 1024 ORDER BY p_brand) - 1 AS INTEGER) AS ord
    FROM part GROUP BY p_partkey // 1024, p_brand"""
ORACLE["q91_listed_parks"] = """SELECT p_partkey // 1024 AS seq, p_brand AS destination_id,
    CAST(row_number() OVER (PARTITION BY p_partkey // 1024, p_brand ORDER BY p_partkey) - 1 AS INTEGER) AS park_ord,
    concat('park-', p_partkey) AS park_id, p_name AS park_name FROM part"""
ORACLE["q92_newest_colocated"] = ORACLE["q46_newest_payload"]
ORACLE["q93_colocated_ranges"] = ORACLE["q41_schedule_ranges"]
ORACLE["q94_stream_outcomes"] = ORACLE["q66_final_outcomes"]
ORACLE["q95_stream_dead_letters"] = ORACLE["q67_dead_letters"]
ORACLE["q96_landed_successes"] = f"""WITH {_FINAL} SELECT request_id AS seq, url AS path, strftime(received_at, {_T}) AS fetched_at,
    status, content_type, body FROM ranked WHERE rn = 1 AND {_OUTCOME} = 'ok'"""
ORACLE["q97_strict_dates"] = f"SELECT ord, instant FROM ({ORACLE['q52_instants']}) WHERE NOT ends_with(v, 'bad')"
