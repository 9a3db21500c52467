"""SQL of the clickstream model for the test profile, as common table expressions."""

from __future__ import annotations

from ..functions.clickstream import BEHAVIORS, RAW_BEHAVIORS
from ..sources.tables import PROFILE

W = PROFILE.window_ms
IN_RANGE = f"event_time_ms BETWEEN {PROFILE.valid_from} AND {PROFILE.valid_to}"
KNOWN = ", ".join(f"'{b}'" for b in BEHAVIORS)
NAMES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in {**RAW_BEHAVIORS, "signup": "cart"}.items())

WITH = f"""WITH ev AS (
  SELECT event_id::VARCHAR AS event_id, event_id AS eid, 'run1' AS run_id, user_id, regexp_extract(props, '([0-9]+)', 1)::BIGINT AS item_id,
         CASE lower(trim(event_type)) {NAMES} ELSE lower(trim(event_type)) END AS behavior, epoch_us(ts) // 1000 AS event_time_ms, epoch_us(ts) // 1000 + 50 + event_id % 200 AS produce_time_ms
  FROM events),
dim AS (SELECT p_partkey AS item_id, p_size::BIGINT AS category_id, CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END AS category_code FROM part WHERE p_partkey % 7 <> 0),
code AS (SELECT item_id, category_id, coalesce(nullif(trim(category_code), ''), 'UNKNOWN') AS category_code FROM dim),
enriched AS (
  SELECT ev.*, coalesce(c.category_id, -1)::BIGINT AS category_id, coalesce(c.category_code, 'UNKNOWN') AS category_code, coalesce(c.category_code, 'UNKNOWN') = 'UNKNOWN' AS dim_miss,
         event_time_ms - event_time_ms % {W} AS window_start_ms
  FROM ev LEFT JOIN code c ON ev.item_id = c.item_id),
offline AS (SELECT * FROM enriched WHERE behavior IN ({KNOWN})),
vfile AS (SELECT * FROM enriched WHERE user_id > 0 AND item_id > 0 AND behavior IN ({KNOWN}) AND {IN_RANGE}),
arr AS (
  SELECT * REPLACE (CASE WHEN again = 1 THEN event_id || 'd' ELSE event_id END AS event_id), 2 * eid + again AS seq, event_time_ms + CASE WHEN eid % 4 = 2 THEN 10800000 ELSE 0 END AS arrival,
         CASE WHEN again = 1 THEN 'duplicate' WHEN eid % 4 = 2 THEN 'late' ELSE 'data' END AS kind
  FROM enriched, (VALUES (0), (1)) r(again) WHERE again = 0 OR eid % 50 = 0),
judged AS (
  SELECT *, CASE WHEN user_id <= 0 THEN 'bad_user' WHEN item_id <= 0 THEN 'bad_item' WHEN behavior NOT IN ({KNOWN}) THEN 'bad_behavior' WHEN NOT ({IN_RANGE}) THEN 'bad_time' END AS reason FROM arr),
marked AS (
  SELECT *, max(CASE WHEN reason IS NULL THEN event_time_ms END) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {PROFILE.watermark_ms + 1} AS wm_before,
         reason IS NULL AND row_number() OVER (PARTITION BY reason IS NULL, user_id, item_id, behavior, event_time_ms ORDER BY arrival, seq) > 1 AS is_dup FROM judged),
cls AS (SELECT *, reason IS NULL AND coalesce(window_start_ms + {W - 1} <= wm_before, false) AS is_late FROM marked),
ontime AS (SELECT * FROM cls WHERE reason IS NULL AND NOT is_late),
stored AS (
  SELECT *, produce_time_ms + 20 + eid * 7 % 400 AS inserted_at_ms, 20 + eid * 7 % 400 AS latency_ms FROM cls WHERE reason IS NULL)
"""

PV_UV = f"""SELECT window_start_ms, window_start_ms + {W} AS window_end_ms, count(*) FILTER (behavior = 'pv') AS pv, count(DISTINCT user_id) FILTER (behavior = 'pv') AS uv, count(*) FILTER (behavior = 'cart') AS cart_cnt,
  count(*) FILTER (behavior = 'buy') AS buy_cnt, count(*) AS events, count(*) FILTER (dim_miss) AS dim_miss, max(produce_time_ms) AS max_produce_time_ms FROM {{rows}} GROUP BY window_start_ms"""

PARTIALS = """SELECT window_start_ms, user_id, count(*) FILTER (behavior = 'pv') AS pv, count(*) FILTER (behavior = 'cart') AS cart_cnt, count(*) FILTER (behavior = 'buy') AS buy_cnt, count(*) AS events,
  count(*) FILTER (dim_miss) AS dim_miss, max(produce_time_ms) AS max_produce_time_ms, min(event_time_ms) FILTER (behavior = 'pv') AS min_pv_ms, min(event_time_ms) FILTER (behavior = 'cart') AS min_cart_ms,
  min(event_time_ms) FILTER (behavior = 'buy') AS min_buy_ms FROM offline GROUP BY window_start_ms, user_id"""

FUNNEL = f"""SELECT window_start_ms, window_start_ms + {W} AS window_end_ms, count(pv) AS pv_users, count(cart) AS cart_users, count(buy) AS buy_users, count(*) FILTER (cart >= pv) AS pv_to_cart_users,
  count(*) FILTER (buy >= cart) AS cart_to_buy_users, count(*) FILTER (buy >= pv) AS pv_to_buy_users
  FROM (SELECT window_start_ms, user_id, min(event_time_ms) FILTER (behavior = 'pv') AS pv, min(event_time_ms) FILTER (behavior = 'cart') AS cart, min(event_time_ms) FILTER (behavior = 'buy') AS buy FROM {{rows}} GROUP BY 1, 2) u
  GROUP BY window_start_ms"""

TOP = f"""SELECT window_start_ms, window_start_ms + {W} AS window_end_ms, rank, item_id, category_code, pv FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start_ms ORDER BY pv DESC, item_id) AS rank FROM (
    SELECT window_start_ms, item_id, category_code, count(*) AS pv FROM {{rows}} WHERE behavior = 'pv' GROUP BY 1, 2, 3) c) k WHERE rank <= {PROFILE.top_n}"""

CATEGORY = f"SELECT window_start_ms, window_start_ms + {W} AS window_end_ms, category_code, count(*) AS pv FROM {{rows}} WHERE behavior = 'pv' GROUP BY window_start_ms, category_code"


def _long(text: str, metrics: tuple[str, ...], value: str) -> str:
    return " UNION ALL ".join(f"SELECT window_start_ms, '{m}' AS metric, {m} AS {value} FROM ({text}) s" for m in metrics)


SUMS = ("pv", "uv", "cart_cnt", "buy_cnt", "dim_miss")
STEPS = ("pv_users", "pv_to_cart_users", "cart_to_buy_users", "pv_to_buy_users", "cart_users", "buy_users")
SIDES = "SELECT coalesce(r.window_start_ms, b.window_start_ms) AS window_start_ms, coalesce(r.metric, b.metric) AS metric, rt, batch FROM ({}) r FULL JOIN ({}) b ON r.window_start_ms = b.window_start_ms AND r.metric = b.metric".format(
    *(" UNION ALL ".join([_long(PV_UV.format(rows=rows), SUMS, v), _long(FUNNEL.format(rows=rows), STEPS, v)]) for rows, v in (("ontime", "rt"), ("vfile", "batch")))
)
