"""Reference SQL (DuckDB dialect) for each plan in ``catalogue.QUERIES``.

These restate the semantics independently of Spark: fixture mappings as CTEs,
integer arithmetic for the half-up averages, plain GROUP BY / JOIN. Streaming
plans compare against their batch twin restricted to windows the watermark
has closed.
"""

from __future__ import annotations

# --- fixture mappings --------------------------------------------------------

ORDERS = """o AS (
  SELECT event_id, user_id, event_type,
    'ORD-' || CAST(event_id AS VARCHAR) AS order_id,
    CASE WHEN user_id % 20 < 13 THEN 'STORE-0001'
         ELSE 'STORE-' || lpad(CAST(user_id % 6 + 2 AS VARCHAR), 4, '0') END AS store_id,
    CASE WHEN event_type <> 'signup' THEN 'CUST-' || CAST(user_id AS VARCHAR) END AS customer_id,
    CASE event_type WHEN 'click' THEN 'IN_STORE_POS' WHEN 'view' THEN 'DRIVE_THRU'
         WHEN 'purchase' THEN 'MOBILE_APP_PICKUP' WHEN 'signup' THEN 'MOBILE_APP_DELIVERY'
         ELSE 'IN_STORE_POS' END AS channel,
    ts AS placed,
    CASE WHEN event_type = 'error' THEN NULL ELSE ts + to_seconds(event_id % 361 + 90) END AS fulfilled,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS amount,
    ts + to_seconds(CASE WHEN event_id % 10 = 0 THEN event_id % 36 + 730 ELSE event_id % 6 END) AS published
  FROM events)"""

CURATED = """c AS (
  SELECT *, CAST(coalesce((epoch_us(date_trunc('second', fulfilled))
                          - epoch_us(date_trunc('second', placed))) // 1000000, 0) AS DOUBLE) AS wait
  FROM o)"""

# malformed records of the derived log (event_id % 1000): 1 junk placed time,
# 2 null store, 3 unknown schema id, 4 empty body
VALID = "c.event_id % 1000 NOT IN (1, 2, 3, 4)"

LOG = """b AS (
  SELECT o.*,
    CASE WHEN event_id % 2 = 0 THEN 101 ELSE 102 END AS body_schema,
    CASE WHEN event_id % 2000 = 3 THEN 4294967295 WHEN event_id % 1000 = 3 THEN 103 WHEN event_id % 2 = 0 THEN 101 ELSE 102 END AS schema_id,
    coalesce('"' || CASE WHEN event_id % 1000 = 1 THEN 'junk'
                         ELSE strftime(placed, '%Y-%m-%dT%H:%M:%S.%fZ') END || '"', 'null') AS j_placed,
    coalesce('"' || strftime(fulfilled, '%Y-%m-%dT%H:%M:%S.%fZ') || '"', 'null') AS j_fulfilled,
    coalesce(CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR), 'null') AS j_amount
  FROM o),
l AS (
  SELECT b.*,
    CASE WHEN event_id % 1000 = 4 THEN '' ELSE
      '{"order_id":' || coalesce('"' || order_id || '"', 'null')
      || ',"store_id":' || coalesce('"' || CASE WHEN event_id % 1000 = 2 THEN NULL ELSE store_id END || '"', 'null')
      || ',"customer_id":' || coalesce('"' || customer_id || '"', 'null')
      || ',"channel":' || coalesce('"' || channel || '"', 'null')
      || ',"order_placed_timestamp":' || j_placed
      || ',"order_fulfilled_timestamp":' || j_fulfilled
      || ',"transaction_amount":' || j_amount
      || ',"items":' || CASE WHEN amount IS NULL THEN '[]' ELSE
           '[{"item_id":"SKU-' || CAST(user_id % 50 AS VARCHAR) || '","item_name":"' || event_type
           || '","quantity":1,"unit_price":' || j_amount || ',"seasonal_syrup_modifiers":'
           || CASE WHEN event_id % 3 = 0 THEN '[{"syrup_name":"Vanilla","pumps":2}]' ELSE '[]' END
           || '}]' END
      || ',"payment":{"primary_tender":"CARD","split_tender":[]'
      || CASE WHEN body_schema = 102 THEN ',"wallet":"W-' || CAST(user_id % 7 AS VARCHAR) || '"' ELSE '' END || '}'
      || CASE WHEN body_schema = 102 THEN ',"loyalty_tier":"'
              || CASE WHEN amount >= 25 THEN 'GOLD' ELSE 'GREEN' END || '"' ELSE '' END
      || '}' END AS body
  FROM b)"""

BRONZE = """SELECT store_id AS kafka_key,
  '00' || lpad(hex(schema_id), 8, '0') || hex(body) AS raw_payload_hex,
  'live_orders' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
  published AS kafka_published_timestamp
FROM l"""


def _metrics(window: str, src: str = "c", where: str = "TRUE", slide: str | None = None,
             extra: str = "", having: str = "", closed: bool = False) -> str:
    """Window metrics oracle; ``slide`` set -> each row in every window covering it."""
    if slide:
        starts = (f"SELECT {src}.*, time_bucket(INTERVAL '{slide}', placed) - k * INTERVAL '{slide}' AS ws "
                  f"FROM {src}, range(0, CAST(epoch(INTERVAL '{window}') / epoch(INTERVAL '{slide}') AS BIGINT)) r(k) "
                  f"WHERE {where}")
    else:
        starts = f"SELECT {src}.*, time_bucket(INTERVAL '{window}', placed) AS ws FROM {src} WHERE {where}"
    limit = ""
    if closed:
        limit = (f" WHERE ws + INTERVAL '{window}' <= "
                 f"(SELECT max(placed) FROM {src} WHERE {where}) - INTERVAL '15 minutes'")
    return f"""w AS ({starts}),
g AS (
  SELECT ws, store_id, count(*) AS cnt,
         CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS t,
         CAST(sum(CAST(wait AS BIGINT)) AS BIGINT) AS wt,
         count(*) - count(amount) AS nulls
  FROM w GROUP BY ws, store_id {having})
SELECT ws AS window_start, ws + INTERVAL '{window}' AS window_end, store_id,
       cnt AS total_order_count,
       CAST((2 * t + cnt) // (2 * cnt) AS DOUBLE) / 100.0 AS avg_order_value,
       CAST((20 * wt + cnt) // (2 * cnt) AS DOUBLE) / 10.0 AS avg_wait_time_seconds{extra}
FROM g{limit}"""


# lagging log partition (W6): rows of partition 3 arrive after all others; one
# is dropped when its window ends at or before the watermark the on-time rows
# left (ms-truncated max placed time - 15 min). On-time rows are never late here
# (publication lags placement by under 13 minutes, the delay is 15).
LAGGING = f"""r AS (SELECT c.*, user_id % 4 AS part FROM c WHERE {VALID}),
lim AS (
  SELECT date_trunc('millisecond', max(placed) FILTER (WHERE part <> 3)) - INTERVAL '15 minutes' AS late_wm,
         date_trunc('millisecond', max(placed)) - INTERVAL '15 minutes' AS end_wm
  FROM r),
k AS (
  SELECT r.* FROM r, lim
  WHERE part <> 3 OR time_bucket(INTERVAL '5 minutes', placed) + INTERVAL '5 minutes' > late_wm)"""


# salt of an order: the first 32 bits of its id's md5
SALTED = """hashed AS (SELECT order_id, CAST(('0x' || substr(md5(order_id), 1, 8))::BIGINT % 16 AS INTEGER) AS salt FROM c)"""


# the slices in which the log arrives: equal spans of publish time
SLICES_SQL = """s AS (
  SELECT l.*, (epoch_us(published) - (SELECT min(epoch_us(published)) FROM l))
    // ((SELECT max(epoch_us(published)) - min(epoch_us(published)) FROM l) // 3 + 1) AS arrival
  FROM l)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + ",\n"


FLAGSHIP_SQL = _with(ORDERS, CURATED) + _metrics("5 minutes")

NESTED = """ln AS (
  SELECT l.l_orderkey AS k, l.l_partkey, l.l_linenumber, CAST(l.l_quantity AS INTEGER) AS q,
         p.p_retailprice AS pr
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey),
per AS (
  SELECT k, CAST(sum(CAST(round(q * pr * 100) AS BIGINT)) AS BIGINT) AS items_cents, count(*) FILTER (pr IS NULL) AS unpriced,
         sum(CAST(q AS DECIMAL(18,2)) * CAST(pr AS DECIMAL(18,2))) AS computed
  FROM ln GROUP BY k),
n AS (
  SELECT o_orderkey AS order_key,
         CASE WHEN o_orderkey % 10 = 0 THEN CAST(round(o_totalprice * 100) AS BIGINT)
              ELSE coalesce(items_cents, 0) END AS amount_cents,
         coalesce(computed, 0) AS computed, coalesce(unpriced, 0) AS unpriced
  FROM orders LEFT JOIN per ON per.k = o_orderkey)"""

LATENESS = "(epoch_us(date_trunc('second', published)) - epoch_us(date_trunc('second', placed))) // 1000000"

ORACLE_SQL: dict[str, str] = {
    "late_replay": _with(ORDERS, CURATED, LAGGING) + _metrics("5 minutes", src="k").replace(
        "FROM g", "FROM g WHERE ws + INTERVAL '5 minutes' <= (SELECT end_wm FROM lim)"),
    "late_ledger": _with(ORDERS, CURATED, LAGGING) + """late AS (
  SELECT time_bucket(INTERVAL '5 minutes', placed) AS window_start, store_id, order_id FROM r, lim
  WHERE part = 3 AND time_bucket(INTERVAL '5 minutes', placed) + INTERVAL '5 minutes' <= late_wm)
SELECT window_start, store_id, order_id, count(*) OVER (PARTITION BY window_start, store_id) AS missing, TRUE AS agrees FROM late""",
    "stream_state": _with(ORDERS, CURATED, SALTED) + f"""v AS (
  SELECT store_id, salt, time_bucket(INTERVAL '5 minutes', placed) AS ws, placed FROM c JOIN hashed USING (order_id) WHERE {VALID}),
lim AS (SELECT date_trunc('millisecond', max(placed)) - INTERVAL '15 minutes' AS wm FROM v)
SELECT 'window, store, salt' AS stage, ws AS window_start, store_id, count(DISTINCT salt) AS rows FROM v, lim
WHERE ws + INTERVAL '5 minutes' > wm GROUP BY ws, store_id
UNION ALL SELECT 'window, store', NULL, NULL, 0""",
    "stream_new_schema": _with(ORDERS, LOG) + """g AS (SELECT 1 AS x)
SELECT event_id AS "offset", CAST(schema_id AS BIGINT) AS schema_id,
  CASE WHEN event_id % 1000 <> 4 THEN order_id END AS order_id,
  CASE WHEN event_id % 1000 NOT IN (2, 4) THEN store_id END AS store_id,
  CASE WHEN event_id % 1000 <> 4 AND schema_id <> 101 THEN CASE WHEN amount >= 25 THEN 'GOLD' ELSE 'GREEN' END END AS loyalty_tier,
  CASE WHEN event_id % 1000 <> 4 AND schema_id <> 101 THEN 'W-' || CAST(user_id % 7 AS VARCHAR) END AS wallet,
  CASE WHEN event_id % 1000 <> 4 THEN amount END AS transaction_amount
FROM l""",
    "schema_growth": _with(ORDERS, LOG, SLICES_SQL) + """g AS (SELECT 1 AS x)
SELECT event_id AS "offset", CASE WHEN event_id % 1000 <> 4 THEN order_id END AS order_id,
  CASE WHEN event_id % 1000 <> 4 THEN amount END AS transaction_amount, CAST(strlen(body) AS BIGINT) AS body_length,
  CASE WHEN event_id % 1000 <> 4 AND arrival > 0 AND body_schema = 102 THEN 'W-' || CAST(user_id % 7 AS VARCHAR) END AS wallet,
  CASE WHEN event_id % 1000 <> 4 AND arrival > 0 AND body_schema = 102 THEN CASE WHEN amount >= 25 THEN 'GOLD' ELSE 'GREEN' END END AS loyalty_tier
FROM s""",
    "ledger_bronze": _with(ORDERS, LOG, SLICES_SQL) + "g AS (SELECT 1 AS x)\n" + BRONZE.replace("SELECT store_id", "SELECT CAST(arrival AS BIGINT) AS batch_id, store_id").replace("FROM l", "FROM s"),
    "ledger_silver": _with(ORDERS, CURATED) + _metrics("5 minutes", where=VALID, closed=True),
    "stream_progress": _with(ORDERS, LOG, SLICES_SQL) + """g AS (
  SELECT arrival, count(*) AS input_rows, count(*) FILTER (WHERE event_id % 1000 IN (1, 2, 3, 4)) AS invalid_rows,
    max(placed) FILTER (WHERE event_id % 1000 NOT IN (1, 2, 3, 4)) AS high FROM s GROUP BY arrival)
SELECT row_number() OVER (ORDER BY arrival) AS run, input_rows, invalid_rows,
  date_trunc('millisecond', max(high) OVER (ORDER BY arrival)) - INTERVAL '15 minutes' AS watermark FROM g""",
    "store_metrics_5m": FLAGSHIP_SQL,
    "store_metrics_5m_direct": FLAGSHIP_SQL,
    "store_metrics_5m_salted": FLAGSHIP_SQL,
    "store_metrics_1h": _with(ORDERS, CURATED) + _metrics("1 hour"),
    "store_metrics_1d": _with(ORDERS, CURATED) + _metrics("1 day"),
    "store_metrics_sliding": _with(ORDERS, CURATED) + _metrics("10 minutes", slide="5 minutes"),
    "store_totals_direct": _with(ORDERS, CURATED) + """g AS (
  SELECT store_id, count(*) AS cnt, CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS t,
         CAST(sum(CAST(wait AS BIGINT)) AS BIGINT) AS wt FROM c GROUP BY store_id)
SELECT store_id, cnt AS order_count,
       CAST((200 * t + cnt) // (2 * cnt) AS DOUBLE) / 10000.0 AS aov,
       CAST((20000 * wt + cnt) // (2 * cnt) AS DOUBLE) / 10000.0 AS avg_wait
FROM g""",
    "salting_parity": _with(ORDERS, CURATED) + """g AS (
  SELECT 1 AS x FROM c GROUP BY time_bucket(INTERVAL '5 minutes', placed), store_id)
SELECT count(*) AS groups, CAST(0 AS BIGINT) AS mismatches FROM g""",
    "partials_invariants": _with(ORDERS, CURATED, SALTED) + """g AS (SELECT 1 AS x)
SELECT time_bucket(INTERVAL '5 minutes', placed) AS window_start, store_id,
       count(*) AS order_count,
       CAST(sum(CAST(round(amount * 100) AS BIGINT)) AS BIGINT) AS amount_cents,
       count(DISTINCT salt) AS n_salts,
       TRUE AS salts_ok
FROM c JOIN hashed USING (order_id) GROUP BY 1, 2""",
    "null_amount_metrics": _with(ORDERS, CURATED) + _metrics(
        "5 minutes", extra=",\n       nulls AS null_amount_count", having="HAVING count(*) - count(amount) > 0"),
    "salt_spread": _with(ORDERS, CURATED, SALTED) + """g AS (SELECT 1 AS x)
SELECT salt, count(*) AS n FROM hashed GROUP BY salt""",
    "wait_time": _with(ORDERS, CURATED) + """g AS (SELECT 1 AS x)
SELECT order_id, wait AS wait_time_seconds FROM c""",
    "curate_orders": _with(ORDERS, CURATED) + f"""g AS (SELECT 1 AS x)
SELECT order_id, store_id, placed AS order_placed_timestamp, fulfilled AS order_fulfilled_timestamp,
       amount AS transaction_amount, wait AS wait_time_seconds
FROM c WHERE {VALID}""",
    "bronze_projection": _with(ORDERS, LOG) + "g AS (SELECT 1 AS x)\n" + BRONZE,
    "wire_frame_split": _with(ORDERS, LOG) + """g AS (SELECT 1 AS x)
SELECT event_id AS "offset", '00' AS magic, CAST(schema_id AS BIGINT) AS schema_id,
       CAST(strlen(body) AS INTEGER) AS body_length
FROM l""",
    "decode_orders": _with(ORDERS, LOG) + """g AS (SELECT 1 AS x)
SELECT event_id AS "offset",
  CASE WHEN event_id % 1000 <> 4 THEN order_id END AS order_id,
  CASE WHEN event_id % 1000 NOT IN (2, 4) THEN store_id END AS store_id,
  CASE WHEN event_id % 1000 <> 4 THEN customer_id END AS customer_id,
  CASE WHEN event_id % 1000 <> 4 THEN channel END AS channel,
  CASE WHEN event_id % 1000 <> 4 THEN CASE WHEN event_id % 1000 = 1 THEN 'junk'
       ELSE strftime(placed, '%Y-%m-%dT%H:%M:%S.%fZ') END END AS order_placed_timestamp,
  CASE WHEN event_id % 1000 <> 4 THEN strftime(fulfilled, '%Y-%m-%dT%H:%M:%S.%fZ') END
    AS order_fulfilled_timestamp,
  CASE WHEN event_id % 1000 <> 4 THEN amount END AS transaction_amount,
  CASE WHEN event_id % 1000 <> 4 THEN CAST(CASE WHEN amount IS NULL THEN 0 ELSE 1 END AS INTEGER) END
    AS n_items,
  CASE WHEN event_id % 1000 <> 4 THEN 'CARD' END AS primary_tender
FROM l""",
    "decode_by_schema_id": _with(ORDERS, LOG) + """g AS (SELECT 1 AS x)
SELECT event_id AS "offset", CAST(schema_id AS BIGINT) AS schema_id,
  CASE WHEN event_id % 1000 NOT IN (3, 4) THEN order_id END AS order_id,
  CASE WHEN event_id % 1000 NOT IN (2, 3, 4) THEN store_id END AS store_id,
  CASE WHEN event_id % 1000 NOT IN (3, 4) AND schema_id = 102
       THEN CASE WHEN amount >= 25 THEN 'GOLD' ELSE 'GREEN' END END AS loyalty_tier,
  CASE WHEN event_id % 1000 NOT IN (3, 4) AND schema_id = 102 THEN 'W-' || CAST(user_id % 7 AS VARCHAR) END AS wallet,
  CASE WHEN event_id % 1000 NOT IN (3, 4) THEN amount END AS transaction_amount
FROM l""",
    "decode_outcomes": _with(ORDERS, LOG) + """g AS (
  SELECT event_id, CASE WHEN event_id % 1000 = 3 THEN 'unknown_schema' WHEN event_id % 1000 = 4 THEN 'bad_body' ELSE 'decoded' END AS outcome FROM l)
SELECT outcome, count(*) AS n, min(event_id) AS first_offset, max(event_id) AS last_offset FROM g GROUP BY outcome""",
    "frame_round_trip": _with(ORDERS) + """g AS (SELECT 1 AS x)
SELECT CASE WHEN event_id % 1000 NOT IN (3, 4) THEN order_id END AS order_id,
       CASE WHEN event_id % 1000 NOT IN (3, 4) THEN TRUE END AS ok FROM o""",
    "stream_bronze": _with(ORDERS, LOG) + "g AS (SELECT 1 AS x)\n" + BRONZE,
    "stream_store_metrics": _with(ORDERS, CURATED) + _metrics("5 minutes", where=VALID, closed=True),
    "stream_store_metrics_salted": _with(ORDERS, CURATED) + _metrics("5 minutes", where=VALID, closed=True),
    "stream_lagging_partition": _with(ORDERS, CURATED, LAGGING) + _metrics("5 minutes", src="k").replace(
        "FROM g", "FROM g WHERE ws + INTERVAL '5 minutes' <= (SELECT end_wm FROM lim)"),
    "dashboard_silver": FLAGSHIP_SQL,
    "bronze_replay_metrics": _with(ORDERS, CURATED) + _metrics("5 minutes", where=VALID),
    "bronze_latest": _with(ORDERS, LOG) + "g AS (SELECT 1 AS x)\n" + BRONZE
        + "\nORDER BY kafka_published_timestamp DESC, partition ASC, \"offset\" ASC LIMIT 20",
    "skew_profile": _with(ORDERS) + """g AS (SELECT store_id, count(*) AS n FROM o GROUP BY store_id)
SELECT store_id, n, n / (SELECT sum(n) FROM g) AS share,
       n / (SELECT median(n) FROM g) AS ratio_to_median
FROM g""",
    "lateness_profile": _with(ORDERS) + f"""g AS (SELECT store_id, {LATENESS} AS lateness FROM o)
SELECT store_id, count(*) AS n, count(*) FILTER (WHERE lateness > 600) AS n_late,
       count(*) FILTER (WHERE lateness > 900) AS n_beyond_delay,
       max(lateness) AS max_lateness_seconds
FROM g GROUP BY store_id""",
    "channel_profile": _with(ORDERS, LOG) + """g AS (
  SELECT CASE WHEN event_id % 1000 NOT IN (3, 4) THEN channel END AS channel FROM l)
SELECT channel, count(*) AS n,
       coalesce(channel IN ('IN_STORE_POS', 'DRIVE_THRU', 'MOBILE_APP_PICKUP', 'MOBILE_APP_DELIVERY'), FALSE)
         AS valid
FROM g GROUP BY channel""",
    "order_total_check": _with(NESTED) + """g AS (SELECT 1 AS x)
SELECT order_key, CAST(amount_cents AS DOUBLE) / 100.0 AS stated,
       CAST(computed AS DOUBLE) AS computed,
       amount_cents = CAST(computed * 100 AS BIGINT) AND unpriced = 0 AS ok
FROM n""",
    "split_tender_check": _with(NESTED) + """g AS (SELECT 1 AS x)
SELECT order_key,
       CAST(CASE WHEN order_key % 10 < 3 THEN 2 ELSE 0 END AS INTEGER) AS n_splits,
       CASE WHEN order_key % 10 < 3 THEN CAST(amount_cents + CASE WHEN order_key % 100 = 1 THEN 100 ELSE 0 END AS DOUBLE) / 100.0 ELSE 0.0 END AS split_total,
       order_key % 100 <> 1 AS ok
FROM n""",
    "item_lines": _with(NESTED) + """g AS (SELECT 1 AS x)
SELECT o_orderkey AS order_key, CAST(ln.l_partkey AS VARCHAR) AS item_id, ln.q AS quantity,
       CASE WHEN ln.l_linenumber % 3 = 0 THEN 'Vanilla' END AS syrup_name,
       CASE WHEN ln.l_linenumber % 3 = 0 THEN 2 END AS pumps
FROM orders LEFT JOIN ln ON ln.k = o_orderkey""",
}
