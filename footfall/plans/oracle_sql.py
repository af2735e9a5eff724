"""Independent DuckDB SQL for every registered query.

Written directly against the pre-registered test tables, in plain SQL
formulations that differ from the Spark plans on purpose: windows over raw
events instead of rollups, a real view x buy join instead of the running-max
as-of, ``row_number`` islands instead of lag markers, ``count(DISTINCT ...)``
instead of rollup row counts.

Conventions: counts BIGINT, ratios DOUBLE, ``r4(x)`` = round half-to-even to 4
digits, ``count(*) FILTER`` rather than ``count_if`` (which gives NULL on
all-NULL input).
"""

from __future__ import annotations


def r4(x: str) -> str:
    return f"(round_even(({x}) * 10000.0, 0) / 10000.0)"


def ratio(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END)"


# events -> RAW (spec of FIXTURES.md §2) -> LOG.
RAW_CTE = """
raw_log AS (
  SELECT event_id AS row_id,
         CASE WHEN k = 98 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CAST(k % 20 AS VARCHAR) AS item_id,
         CASE WHEN k = 99 THEN 'x' WHEN k = 96 THEN '2d' WHEN k = 95 THEN '1f'
              WHEN event_type IN ('view', 'click') THEN '1'
              WHEN event_type = 'signup' THEN CASE WHEN value < 35 THEN '2' ELSE '3' END
              WHEN event_type = 'purchase' THEN CASE WHEN value >= 100 THEN '4' ELSE '1' END
              WHEN event_type = 'error' THEN '9' END AS behavior_type,
         CAST((k % 20) % 5 AS VARCHAR) AS item_category,
         CASE WHEN k = 97 THEN 'bad' WHEN k = 94 THEN '1500-01-01 05' WHEN k = 93 THEN '3000-01-01 05'
              ELSE strftime(ts, '%Y-%m-%d %H') END AS "time"
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events) e
)"""

CLEAN_CTE = """
checked AS (
  SELECT *, TRY_CAST(behavior_type AS DOUBLE) AS b_num,
         CASE WHEN TRY_STRPTIME("time", '%Y-%m-%d %H') BETWEEN TIMESTAMP '1677-09-21 01:00:00'
                   AND TIMESTAMP '2262-04-11 23:00:00' THEN TRY_STRPTIME("time", '%Y-%m-%d %H') END AS t_parsed
  FROM raw_log
),
clean AS (
  SELECT row_id,
         CAST(user_id AS BIGINT) AS user_id,
         CAST(item_id AS BIGINT) AS item_id,
         CAST(b_num AS INTEGER) AS behavior_type,
         CAST(item_category AS BIGINT) AS item_category,
         CAST(t_parsed AS TIMESTAMP) AS "timestamp"
  FROM checked
  WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND item_category IS NOT NULL
    AND t_parsed IS NOT NULL AND b_num IN (1, 2, 3, 4)
),
ev AS (
  SELECT *, CAST("timestamp" AS DATE) AS d, CAST(hour("timestamp") AS INTEGER) AS h,
         CAST(isodow("timestamp") - 1 AS INTEGER) AS wd
  FROM clean
)"""

# Scale fixture: lineitem x orders -> LOG (FIXTURES.md §3).
LINEITEM_CTE = """
clean AS (
  SELECT CAST(l.l_orderkey * 16 + l.l_linenumber AS BIGINT) AS row_id,
         CAST(o.o_custkey AS BIGINT) AS user_id,
         CAST(l.l_partkey AS BIGINT) AS item_id,
         CASE WHEN l.l_returnflag = 'N' THEN 1
              WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F' THEN 1
              WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN 2
              WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 3
              WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'O' THEN 4 END AS behavior_type,
         CAST(l.l_partkey % 50 AS BIGINT) AS item_category,
         CAST(l.l_shipdate AS TIMESTAMP) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
ev AS (
  SELECT *, CAST("timestamp" AS DATE) AS d, CAST(hour("timestamp") AS INTEGER) AS h,
         CAST(isodow("timestamp") - 1 AS INTEGER) AS wd
  FROM clean WHERE behavior_type IS NOT NULL
)"""


def with_log(body: str, *extra_ctes: str, source: str = "events") -> str:
    head = [RAW_CTE, CLEAN_CTE] if source == "events" else [LINEITEM_CTE]
    return "WITH " + ",\n".join(head + list(extra_ctes)) + "\n" + body


def cnt(cond: str | None = None) -> str:
    return "count(*)" if cond is None else f"count(*) FILTER (WHERE {cond})"


# ---------------------------------------------------------------------------
# User table
# ---------------------------------------------------------------------------

USER_CTES = [
    """
u_basic AS (
  SELECT user_id,
         count(behavior_type) AS total_behavior_cnt,
         count(*) FILTER (WHERE behavior_type = 1) AS pv_cnt,
         count(*) FILTER (WHERE behavior_type = 2) AS fav_cnt,
         count(*) FILTER (WHERE behavior_type = 3) AS cart_cnt,
         count(*) FILTER (WHERE behavior_type = 4) AS buy_cnt,
         count(DISTINCT d) AS active_days,
         count(DISTINCT behavior_type) AS behavior_type_cnt,
         min("timestamp") AS first_behavior_time,
         max("timestamp") AS last_behavior_time,
         count(DISTINCT h) AS active_hour_cnt,
         count(DISTINCT h // 2) AS active_2h_slot,
         count(DISTINCT h // 3) AS active_3h_slot,
         count(DISTINCT h // 6) AS active_6h_slot,
         count(*) FILTER (WHERE h >= 0 AND h < 6) AS late_night_behavior_cnt,
         count(*) FILTER (WHERE h >= 6 AND h < 12) AS morning_behavior_cnt,
         count(*) FILTER (WHERE h >= 12 AND h < 18) AS afternoon_behavior_cnt,
         count(*) FILTER (WHERE h >= 18 AND h < 24) AS evening_behavior_cnt,
         count(*) FILTER (WHERE wd >= 5) AS weekend_behavior_cnt,
         count(*) FILTER (WHERE wd < 5) AS weekday_behavior_cnt,
         count(DISTINCT item_id) AS item_diversity,
         count(DISTINCT item_category) AS category_diversity,
         count(DISTINCT item_id) FILTER (WHERE behavior_type = 1) AS viewed_item_cnt,
         count(DISTINCT item_id) FILTER (WHERE behavior_type = 4) AS bought_item_cnt,
         count(DISTINCT item_id) FILTER (WHERE behavior_type = 3) AS cart_item_cnt,
         count(DISTINCT item_id) FILTER (WHERE behavior_type = 2) AS fav_item_cnt,
         count(DISTINCT item_category) FILTER (WHERE behavior_type = 1) AS viewed_category_cnt,
         count(DISTINCT item_category) FILTER (WHERE behavior_type = 4) AS bought_category_cnt,
         count(DISTINCT item_category) FILTER (WHERE behavior_type = 3) AS cart_category_cnt,
         count(DISTINCT item_category) FILTER (WHERE behavior_type = 2) AS fav_category_cnt
  FROM ev GROUP BY user_id
)""",
    """
u_daily AS (
  SELECT user_id, max(c) AS max_daily_behavior_cnt, min(c) AS min_daily_behavior_cnt
  FROM (SELECT user_id, d, count(*) AS c FROM ev GROUP BY user_id, d) x GROUP BY user_id
)""",
    """
u_peak_hour AS (
  SELECT user_id, h AS peak_active_hour FROM (
    SELECT user_id, h, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, h) AS rn
    FROM ev GROUP BY user_id, h) x WHERE rn = 1
)""",
    """
u_peak_6h AS (
  SELECT user_id, CAST(s AS INTEGER) AS peak_6h_slot FROM (
    SELECT user_id, h // 6 AS s, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, h // 6) AS rn
    FROM ev GROUP BY user_id, h // 6) x WHERE rn = 1
)""",
    """
u_items AS (
  SELECT user_id, item_id, count(*) AS n,
         count(*) FILTER (WHERE behavior_type = 1) AS pv,
         count(*) FILTER (WHERE behavior_type = 4) AS buy
  FROM ev GROUP BY user_id, item_id
)""",
    """
u_item_pref AS (
  SELECT user_id,
         count(*) FILTER (WHERE pv > 1) AS repeat_view_item_cnt,
         count(*) FILTER (WHERE buy > 1) AS repeat_buy_item_cnt,
         count(*) FILTER (WHERE pv > 1 AND buy = 0) AS repeat_view_without_buy
  FROM u_items GROUP BY user_id
)""",
    """
u_top_item AS (
  SELECT user_id, item_id AS top_item_id, n AS top_item_behavior_cnt FROM (
    SELECT user_id, item_id, n, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, item_id) AS rn
    FROM u_items) x WHERE rn = 1
)""",
    """
u_top_cat AS (
  SELECT user_id, item_category AS top_category_id, n AS top_category_behavior_cnt FROM (
    SELECT user_id, item_category, count(*) AS n,
           row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, item_category) AS rn
    FROM ev GROUP BY user_id, item_category) x WHERE rn = 1
)""",
    """
u_seq AS (
  SELECT user_id,
         avg(pos - 1) FILTER (WHERE behavior_type = 4) AS avg_steps_to_buy,
         count(*) FILTER (WHERE item_category <> prev_cat) AS category_shift_cnt
  FROM (
    SELECT user_id, behavior_type, item_category,
           row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", row_id) AS pos,
           lag(item_category) OVER (PARTITION BY user_id ORDER BY "timestamp", row_id) AS prev_cat
    FROM ev) x
  GROUP BY user_id
)""",
    """
u_buy_gap AS (
  SELECT user_id, avg(gap) AS avg_buy_interval FROM (
    SELECT user_id,
           CAST(date_diff('second', lag("timestamp") OVER (PARTITION BY user_id ORDER BY "timestamp", row_id),
                          "timestamp") AS DOUBLE) / 3600.0 AS gap
    FROM ev WHERE behavior_type = 4) x
  GROUP BY user_id
)""",
    """
u_vbfb AS (
  SELECT e.user_id, count(*) FILTER (WHERE e.behavior_type = 1 AND e."timestamp" < f.fb) AS view_before_first_buy_cnt
  FROM ev e LEFT JOIN (SELECT user_id, min("timestamp") AS fb FROM ev WHERE behavior_type = 4 GROUP BY user_id) f
    ON e.user_id = f.user_id
  GROUP BY e.user_id
)""",
    """
u_pairs AS (
  SELECT v.user_id, v.item_id, b."timestamp" AS buy_time, max(v."timestamp") AS last_view
  FROM ev v JOIN ev b
    ON v.user_id = b.user_id AND v.item_id = b.item_id
   AND v.behavior_type = 1 AND b.behavior_type = 4 AND v."timestamp" <= b."timestamp"
  GROUP BY v.user_id, v.item_id, b."timestamp"
)""",
    """
u_first_interval AS (
  SELECT user_id, gap AS first_buy_interval FROM (
    SELECT user_id, CAST(date_diff('second', last_view, buy_time) AS DOUBLE) / 3600.0 AS gap,
           row_number() OVER (PARTITION BY user_id ORDER BY buy_time, item_id) AS rn
    FROM u_pairs) x WHERE rn = 1
)""",
    """
u_impulsive AS (
  SELECT DISTINCT v.user_id
  FROM ev v JOIN ev b
    ON v.user_id = b.user_id AND v.item_id = b.item_id
   AND v.behavior_type = 1 AND b.behavior_type = 4
  WHERE date_diff('second', v."timestamp", b."timestamp") BETWEEN 0 AND 3600
)""",
    """
u_streak AS (
  SELECT user_id, max(len) AS max_consecutive_active_days, avg(len) AS avg_consecutive_active_days FROM (
    SELECT user_id, grp, count(*) AS len FROM (
      SELECT user_id, d - CAST(row_number() OVER (PARTITION BY user_id ORDER BY d) AS INTEGER) AS grp
      FROM (SELECT DISTINCT user_id, d FROM ev) a) b
    GROUP BY user_id, grp) c
  GROUP BY user_id
)""",
    """
u_cat_streak AS (
  SELECT user_id, max(len) AS dominant_category_stability FROM (
    SELECT user_id, top_cat, grp, count(*) AS len FROM (
      SELECT user_id, top_cat,
             d - CAST(row_number() OVER (PARTITION BY user_id, top_cat ORDER BY d) AS INTEGER) AS grp
      FROM (
        SELECT user_id, d, item_category AS top_cat,
               row_number() OVER (PARTITION BY user_id, d ORDER BY count(*) DESC, item_category) AS rn
        FROM ev GROUP BY user_id, d, item_category) t
      WHERE rn = 1) s
    GROUP BY user_id, top_cat, grp) r
  GROUP BY user_id
)""",
    """
u_recent AS (
  SELECT e.user_id,
         count(*) FILTER (WHERE e.d >= m.end_d - 2) AS recent_3d_behavior_cnt,
         count(*) FILTER (WHERE e.d >= m.end_d - 6) AS recent_7d_behavior_cnt,
         count(*) FILTER (WHERE e.d >= m.end_d - 2 AND e.behavior_type = 4) AS recent_3d_buy_cnt,
         count(*) FILTER (WHERE e.d >= m.end_d - 6 AND e.behavior_type = 4) AS recent_7d_buy_cnt,
         CAST(max(m.end_d) - max(e.d) AS BIGINT) AS inactive_gap_days
  FROM ev e CROSS JOIN (SELECT max(d) AS end_d FROM ev) m
  GROUP BY e.user_id
)""",
]

USER_BASE_CTE = f"""
u_base AS (
  SELECT b.*,
         {ratio('b.total_behavior_cnt', 'b.active_days')} AS avg_behavior_per_day,
         {ratio('b.total_behavior_cnt', 'b.item_diversity')} AS avg_behavior_per_item,
         {ratio('b.total_behavior_cnt', 'b.category_diversity')} AS avg_behavior_per_category,
         dl.max_daily_behavior_cnt, dl.min_daily_behavior_cnt,
         {ratio('b.buy_cnt', 'b.total_behavior_cnt')} AS user_buy_rate,
         {ratio('b.cart_cnt', 'b.total_behavior_cnt')} AS user_cart_rate,
         {ratio('b.fav_cnt', 'b.total_behavior_cnt')} AS user_fav_rate,
         {ratio('b.pv_cnt', 'b.total_behavior_cnt')} AS user_pv_rate,
         {ratio('(b.buy_cnt + b.cart_cnt)', 'b.pv_cnt')} AS user_intent_score,
         {ratio('b.buy_cnt', 'b.cart_cnt')} AS cart_buy_ratio,
         {ratio('b.buy_cnt', 'b.fav_cnt')} AS fav_buy_ratio,
         {ratio('b.buy_cnt', 'b.pv_cnt')} AS pv_buy_ratio,
         {ratio('b.cart_cnt', 'b.pv_cnt')} AS pv_to_cart_ratio,
         {ratio('b.pv_cnt', 'b.buy_cnt')} AS hesitation_score,
         CAST(CAST(b.last_behavior_time AS DATE) - CAST(b.first_behavior_time AS DATE) + 1 AS BIGINT) AS user_lifetime_days,
         ph.peak_active_hour,
         {ratio('b.morning_behavior_cnt', 'b.total_behavior_cnt')} AS morning_ratio,
         {ratio('b.evening_behavior_cnt', 'b.total_behavior_cnt')} AS evening_ratio,
         {ratio('b.late_night_behavior_cnt', 'b.total_behavior_cnt')} AS late_night_ratio,
         {ratio('b.weekend_behavior_cnt', 'b.total_behavior_cnt')} AS weekend_ratio,
         b.active_hour_cnt AS active_1h_slot,
         ph.peak_active_hour AS peak_1h_slot,
         p6.peak_6h_slot,
         ip.repeat_view_item_cnt, ip.repeat_buy_item_cnt, ip.repeat_view_without_buy,
         ti.top_item_id, ti.top_item_behavior_cnt,
         {ratio('ti.top_item_behavior_cnt', 'b.total_behavior_cnt')} AS favorite_item_ratio,
         ip.repeat_buy_item_cnt > 0 AS repeat_buy_same_item_flag,
         tc.top_category_id, tc.top_category_behavior_cnt,
         {ratio('tc.top_category_behavior_cnt', 'b.total_behavior_cnt')} AS top_category_behavior_ratio,
         sq.avg_steps_to_buy, fi.first_buy_interval, bg.avg_buy_interval,
         vb.view_before_first_buy_cnt,
         sq.category_shift_cnt,
         cs.dominant_category_stability,
         st.max_consecutive_active_days, st.avg_consecutive_active_days,
         rc.recent_3d_behavior_cnt, rc.recent_7d_behavior_cnt, rc.recent_3d_buy_cnt, rc.recent_7d_buy_cnt,
         rc.inactive_gap_days,
         {ratio('b.buy_cnt', 'b.active_days')} AS purchase_frequency,
         ip.repeat_buy_item_cnt > 0 AS repurchase_flag,
         im.user_id IS NOT NULL AS impulsive_buy_flag
  FROM u_basic b
  LEFT JOIN u_daily dl ON b.user_id = dl.user_id
  LEFT JOIN u_peak_hour ph ON b.user_id = ph.user_id
  LEFT JOIN u_peak_6h p6 ON b.user_id = p6.user_id
  LEFT JOIN u_item_pref ip ON b.user_id = ip.user_id
  LEFT JOIN u_top_item ti ON b.user_id = ti.user_id
  LEFT JOIN u_top_cat tc ON b.user_id = tc.user_id
  LEFT JOIN u_seq sq ON b.user_id = sq.user_id
  LEFT JOIN u_first_interval fi ON b.user_id = fi.user_id
  LEFT JOIN u_buy_gap bg ON b.user_id = bg.user_id
  LEFT JOIN u_vbfb vb ON b.user_id = vb.user_id
  LEFT JOIN u_cat_streak cs ON b.user_id = cs.user_id
  LEFT JOIN u_streak st ON b.user_id = st.user_id
  LEFT JOIN u_recent rc ON b.user_id = rc.user_id
  LEFT JOIN u_impulsive im ON b.user_id = im.user_id
)"""

USER_THRESHOLDS_CTE = """
u_q AS (
  SELECT quantile_cont(favorite_item_ratio, 0.75) AS q75_favorite_item_ratio,
         quantile_cont(category_diversity, 0.75) AS q75_category_diversity,
         quantile_cont(cart_cnt, 0.75) AS q75_cart_cnt,
         quantile_cont(category_shift_cnt, 0.75) AS q75_category_shift_cnt,
         quantile_cont(max_consecutive_active_days, 0.75) AS q75_max_consecutive_active_days,
         quantile_cont(active_days, 0.75) AS q75_active_days,
         quantile_cont(buy_cnt, 0.75) AS q75_buy_cnt,
         quantile_cont(cart_cnt + fav_cnt, 0.75) AS q75_cart_fav_cnt,
         quantile_cont(pv_buy_ratio, 0.75) AS q75_pv_buy_ratio,
         quantile_cont(pv_cnt, 0.75) AS q75_pv_cnt,
         quantile_cont(fav_cnt, 0.75) AS q75_fav_cnt,
         quantile_cont(user_lifetime_days, 0.75) AS q75_user_lifetime_days,
         quantile_cont(inactive_gap_days, 0.75) AS q75_inactive_gap_days,
         quantile_cont(user_lifetime_days, 0.25) AS q25_user_lifetime_days,
         quantile_cont(recent_7d_behavior_cnt, 0.25) AS q25_recent_7d_behavior_cnt,
         quantile_cont(buy_cnt, 0.5) AS median_buy_cnt,
         quantile_cont(pv_buy_ratio, 0.5) AS median_pv_buy_ratio
  FROM u_base
)"""


def _f(cond: str) -> str:
    return f"coalesce({cond}, false)"


USER_FLAGS_CTE = f"""
u_flags AS (
  SELECT b.*,
    {_f('b.favorite_item_ratio >= q.q75_favorite_item_ratio')} AS single_item_dependency_flag,
    {_f('b.category_diversity >= q.q75_category_diversity')} AS cross_category_user_flag,
    {_f('b.cart_cnt >= q.q75_cart_cnt AND b.buy_cnt = 0')} AS long_cart_no_buy_flag,
    {_f('b.category_shift_cnt >= q.q75_category_shift_cnt')} AS cross_category_transition_flag,
    {_f('b.max_consecutive_active_days >= q.q75_max_consecutive_active_days')} AS active_streak_flag,
    {_f('b.active_days >= q.q75_active_days')} AS active_user_flag,
    {_f('b.buy_cnt >= q.q75_buy_cnt')} AS high_value_user_flag,
    {_f('b.cart_cnt + b.fav_cnt >= q.q75_cart_fav_cnt AND b.buy_cnt <= q.median_buy_cnt')} AS potential_user_flag,
    {_f('b.buy_cnt >= q.q75_buy_cnt AND b.active_days >= q.q75_active_days')} AS loyal_user_flag,
    {_f('b.pv_buy_ratio >= q.q75_pv_buy_ratio')} AS high_conversion_user_flag,
    {_f('b.cart_cnt + b.fav_cnt >= q.q75_cart_fav_cnt AND b.buy_cnt <= q.median_buy_cnt')} AS intent_user_flag,
    {_f('b.pv_cnt >= q.q75_pv_cnt AND b.pv_buy_ratio <= q.median_pv_buy_ratio')} AS low_conversion_flag,
    {_f('b.pv_cnt >= q.q75_pv_cnt AND b.buy_cnt <= q.median_buy_cnt')} AS high_pv_low_buy_flag,
    {_f('b.fav_cnt >= q.q75_fav_cnt AND b.buy_cnt <= q.median_buy_cnt')} AS high_fav_low_buy_flag,
    {_f('b.user_lifetime_days <= q.q25_user_lifetime_days')} AS new_user_flag,
    {_f('b.user_lifetime_days >= q.q75_user_lifetime_days AND b.active_days >= q.q75_active_days')} AS mature_user_flag,
    {_f('b.inactive_gap_days >= q.q75_inactive_gap_days')} AS silent_user_flag,
    {_f('b.recent_7d_behavior_cnt <= q.q25_recent_7d_behavior_cnt AND b.inactive_gap_days >= q.q75_inactive_gap_days')} AS churn_risk_flag
  FROM u_base b CROSS JOIN u_q q
),
u_final AS (
  SELECT f.*,
    CASE WHEN new_user_flag THEN 'new_user' WHEN mature_user_flag THEN 'mature_user'
         WHEN silent_user_flag THEN 'silent_user' WHEN churn_risk_flag THEN 'churn_risk_user'
         ELSE 'normal_user' END AS user_maturity_stage,
    round_even((0.35::DOUBLE * ra + 0.25::DOUBLE * rs + 0.25::DOUBLE * rr + 0.15::DOUBLE * (1.0::DOUBLE - rg)) * 100.0::DOUBLE * 100.0, 0) / 100.0
      AS retention_score
  FROM (
    SELECT *,
      (rank() OVER (ORDER BY active_days) + CAST(count(*) OVER (PARTITION BY active_days) - 1 AS DOUBLE) / 2.0)
        / CAST(count(*) OVER () AS DOUBLE) AS ra,
      (rank() OVER (ORDER BY max_consecutive_active_days)
        + CAST(count(*) OVER (PARTITION BY max_consecutive_active_days) - 1 AS DOUBLE) / 2.0) / CAST(count(*) OVER () AS DOUBLE) AS rs,
      (rank() OVER (ORDER BY recent_7d_behavior_cnt)
        + CAST(count(*) OVER (PARTITION BY recent_7d_behavior_cnt) - 1 AS DOUBLE) / 2.0) / CAST(count(*) OVER () AS DOUBLE) AS rr,
      (rank() OVER (ORDER BY inactive_gap_days)
        + CAST(count(*) OVER (PARTITION BY inactive_gap_days) - 1 AS DOUBLE) / 2.0) / CAST(count(*) OVER () AS DOUBLE) AS rg
    FROM u_flags) f
)"""

ALL_USER_CTES = USER_CTES + [USER_BASE_CTE, USER_THRESHOLDS_CTE, USER_FLAGS_CTE]

# Schema fact: DOUBLE columns of the user table (rounded to 4 digits).
USER_DOUBLES = {
    "avg_behavior_per_day", "avg_behavior_per_item", "avg_behavior_per_category",
    "user_buy_rate", "user_cart_rate", "user_fav_rate", "user_pv_rate", "user_intent_score",
    "cart_buy_ratio", "fav_buy_ratio", "pv_buy_ratio", "pv_to_cart_ratio", "hesitation_score",
    "morning_ratio", "evening_ratio", "late_night_ratio", "weekend_ratio",
    "avg_consecutive_active_days", "favorite_item_ratio", "top_category_behavior_ratio",
    "purchase_frequency", "retention_score", "avg_steps_to_buy", "first_buy_interval",
    "avg_buy_interval",
}


def select_columns(columns: list[str], doubles: set[str], source: str) -> str:
    items = []
    for c in columns:
        items.append(f"{r4(c)} AS {c}" if c in doubles else c)
    return f"SELECT {', '.join(items)} FROM {source}"


def user_sql(columns: list[str]) -> str:
    return with_log(select_columns(columns, USER_DOUBLES, "u_final"), *ALL_USER_CTES)


def user_thresholds_sql() -> str:
    return with_log("SELECT * FROM u_q", *(USER_CTES + [USER_BASE_CTE, USER_THRESHOLDS_CTE]))


# ---------------------------------------------------------------------------
# Item and category tables
# ---------------------------------------------------------------------------

ENTITY_DOUBLES = {
    "avg_behavior_per_user", "avg_behavior_per_item", "avg_daily_behavior_cnt", "pv_buy_ratio",
    "cart_buy_ratio", "fav_buy_ratio", "pv_cart_ratio", "buy_user_ratio", "weekend_behavior_ratio",
    "late_night_behavior_ratio", "top_item_ratio",
}


def entity_ctes(key: str) -> list[str]:
    life = "item_lifetime_days" if key == "item_id" else "category_lifetime_days"
    return [f"""
e_agg AS (
  SELECT {key},
         count(*) AS total_behavior_cnt,
         count(DISTINCT user_id) AS unique_user_cnt,
         count(DISTINCT item_id) AS unique_item_cnt,
         count(DISTINCT d) AS active_days,
         min("timestamp") AS first_behavior_time,
         max("timestamp") AS last_behavior_time,
         count(*) FILTER (WHERE behavior_type = 1) AS pv_cnt,
         count(*) FILTER (WHERE behavior_type = 2) AS fav_cnt,
         count(*) FILTER (WHERE behavior_type = 3) AS cart_cnt,
         count(*) FILTER (WHERE behavior_type = 4) AS buy_cnt,
         count(DISTINCT user_id) FILTER (WHERE behavior_type = 1) AS unique_view_user_cnt,
         count(DISTINCT user_id) FILTER (WHERE behavior_type = 4) AS unique_buy_user_cnt,
         count(*) FILTER (WHERE wd >= 5) AS weekend_behavior_cnt,
         count(*) FILTER (WHERE h >= 0 AND h < 6) AS late_night_behavior_cnt
  FROM ev GROUP BY {key}
)""", f"""
e_daily AS (
  SELECT {key}, max(c) AS max_daily_behavior_cnt, min(c) AS min_daily_behavior_cnt
  FROM (SELECT {key}, d, count(*) AS c FROM ev GROUP BY {key}, d) x GROUP BY {key}
)""", f"""
e_peak AS (
  SELECT {key}, h AS peak_active_hour FROM (
    SELECT {key}, h, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, h) AS rn
    FROM ev GROUP BY {key}, h) x WHERE rn = 1
)""", f"""
e_top_item AS (
  SELECT {key}, max(c) AS top_item_behavior_cnt
  FROM (SELECT {key}, item_id, count(*) AS c FROM ev GROUP BY {key}, item_id) x GROUP BY {key}
)""", f"""
e_final AS (
  SELECT a.*, dl.max_daily_behavior_cnt, dl.min_daily_behavior_cnt, p.peak_active_hour,
         t.top_item_behavior_cnt,
         {ratio('a.total_behavior_cnt', 'a.unique_user_cnt')} AS avg_behavior_per_user,
         {ratio('a.total_behavior_cnt', 'a.unique_item_cnt')} AS avg_behavior_per_item,
         {ratio('a.total_behavior_cnt', 'a.active_days')} AS avg_daily_behavior_cnt,
         {ratio('a.buy_cnt', 'a.pv_cnt')} AS pv_buy_ratio,
         {ratio('a.buy_cnt', 'a.cart_cnt')} AS cart_buy_ratio,
         {ratio('a.buy_cnt', 'a.fav_cnt')} AS fav_buy_ratio,
         {ratio('a.cart_cnt', 'a.pv_cnt')} AS pv_cart_ratio,
         {ratio('a.unique_buy_user_cnt', 'a.unique_view_user_cnt')} AS buy_user_ratio,
         CAST(CAST(a.last_behavior_time AS DATE) - CAST(a.first_behavior_time AS DATE) + 1 AS BIGINT) AS {life},
         {ratio('a.weekend_behavior_cnt', 'a.total_behavior_cnt')} AS weekend_behavior_ratio,
         {ratio('a.late_night_behavior_cnt', 'a.total_behavior_cnt')} AS late_night_behavior_ratio,
         {ratio('t.top_item_behavior_cnt', 'a.total_behavior_cnt')} AS top_item_ratio
  FROM e_agg a
  LEFT JOIN e_daily dl ON a.{key} = dl.{key}
  LEFT JOIN e_peak p ON a.{key} = p.{key}
  LEFT JOIN e_top_item t ON a.{key} = t.{key}
)"""]


def entity_sql(key: str, columns: list[str], source: str = "events") -> str:
    return with_log(select_columns(columns, ENTITY_DOUBLES, "e_final"), *entity_ctes(key), source=source)


# ---------------------------------------------------------------------------
# Cleaning, profiling and operator-level queries
# ---------------------------------------------------------------------------

RAW_COLS = "row_id, user_id, item_id, behavior_type, item_category, \"time\""

ORACLE_EXTRA: dict[str, str] = {}

ORACLE_EXTRA["raw_behavior"] = with_log(f"SELECT {RAW_COLS} FROM raw_log")
ORACLE_EXTRA["clean_log"] = with_log('SELECT row_id, user_id, item_id, behavior_type, item_category, "timestamp" FROM clean')
ORACLE_EXTRA["csv_roundtrip"] = ORACLE_EXTRA["clean_log"]
ORACLE_EXTRA["parquet_roundtrip"] = ORACLE_EXTRA["clean_log"]
ORACLE_EXTRA["publish_and_count"] = with_log(
    "SELECT count(*) AS total_rows, count(*) AS expected_rows, true AS matched FROM clean")
ORACLE_EXTRA["cleaning_report"] = with_log("""
SELECT count(*) AS rows_in,
       count(*) FILTER (WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND item_category IS NOT NULL
                        AND t_parsed IS NOT NULL AND b_num IN (1, 2, 3, 4)) AS rows_kept,
       count(*) FILTER (WHERE NOT (user_id IS NOT NULL AND item_id IS NOT NULL AND item_category IS NOT NULL
                        AND t_parsed IS NOT NULL AND coalesce(b_num IN (1, 2, 3, 4), false))) AS rows_removed,
       count(*) FILTER (WHERE user_id IS NULL) AS missing_user_id,
       count(*) FILTER (WHERE item_id IS NULL) AS missing_item_id,
       count(*) FILTER (WHERE item_category IS NULL) AS missing_item_category,
       count(*) FILTER (WHERE NOT coalesce(b_num IN (1, 2, 3, 4), false)) AS invalid_behavior,
       count(*) FILTER (WHERE t_parsed IS NULL) AS invalid_time
FROM checked""")
ORACLE_EXTRA["preview"] = with_log(f"SELECT {RAW_COLS} FROM raw_log ORDER BY row_id LIMIT 5")
_raw_cols = ["row_id", "user_id", "item_id", "behavior_type", "item_category", "time"]
_raw_types = ["bigint", "string", "string", "string", "string", "string"]
ORACLE_EXTRA["column_info"] = with_log(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS dtype, count(\"{c}\") AS non_null_count FROM raw_log"
    for i, (c, t) in enumerate(zip(_raw_cols, _raw_types))))
ORACLE_EXTRA["null_counts"] = with_log(" UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS null_count FROM raw_log"
    for i, c in enumerate(_raw_cols)))
ORACLE_EXTRA["duplicate_rows"] = with_log("""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_cnt,
       CASE WHEN sum(n) > 0 THEN CAST(sum(n - 1) AS DOUBLE) / CAST(sum(n) AS DOUBLE) END AS duplicate_ratio,
       CAST(coalesce(sum(n), 0) AS BIGINT) AS row_cnt
FROM (SELECT user_id, item_id, behavior_type, item_category, "time", count(*) AS n
      FROM raw_log GROUP BY ALL) g""")
ORACLE_EXTRA["behavior_distribution"] = with_log(
    "SELECT behavior_type, count(*) AS cnt FROM raw_log GROUP BY behavior_type")
ORACLE_EXTRA["invalid_behavior"] = with_log(
    f"SELECT {RAW_COLS} FROM checked WHERE NOT coalesce(b_num IN (1, 2, 3, 4), false)")
ORACLE_EXTRA["invalid_time"] = with_log(f"SELECT {RAW_COLS} FROM checked WHERE t_parsed IS NULL")
ORACLE_EXTRA["cardinalities"] = with_log("""
SELECT count(DISTINCT user_id) AS user_id_nunique, count(DISTINCT item_id) AS item_id_nunique,
       count(DISTINCT item_category) AS item_category_nunique FROM raw_log""")
ORACLE_EXTRA["overview"] = with_log("""
SELECT count(*) AS total_rows, count(DISTINCT user_id) AS user_cnt, count(DISTINCT item_id) AS item_cnt,
       count(DISTINCT item_category) AS category_cnt, min("timestamp") AS first_time,
       max("timestamp") AS last_time,
       CAST(count(*) AS DOUBLE) / CAST(count(DISTINCT user_id) AS DOUBLE) AS avg_behavior_per_user
FROM clean""")
ORACLE_EXTRA["enriched_log"] = with_log("""
SELECT row_id, user_id, item_id, behavior_type, item_category, "timestamp", CAST(d AS TIMESTAMP) AS date,
       h AS hour, wd AS weekday,
       CASE behavior_type WHEN 1 THEN 'pv' WHEN 2 THEN 'fav' WHEN 3 THEN 'cart' WHEN 4 THEN 'buy' END AS behavior
FROM ev""")
ORACLE_EXTRA["event_order"] = with_log("""
SELECT row_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", row_id) AS behavior_order
FROM ev""")
ORACLE_EXTRA["last_view_before_buy"] = with_log("""
SELECT user_id, item_id, buy_time, last_view AS last_view_time,
       CAST(date_diff('second', last_view, buy_time) AS DOUBLE) / 3600.0 AS pv_to_buy_hours
FROM u_pairs""", *USER_CTES)
ORACLE_EXTRA["view_buy_pairs"] = with_log("""
SELECT v.user_id, v.item_id, count(*) AS pair_cnt
FROM ev v JOIN ev b
  ON v.user_id = b.user_id AND v.item_id = b.item_id
 AND v.behavior_type = 1 AND b.behavior_type = 4 AND v."timestamp" <= b."timestamp"
GROUP BY v.user_id, v.item_id""")
ORACLE_EXTRA["top_category_per_day"] = with_log("""
SELECT user_id, CAST(d AS TIMESTAMP) AS date, item_category AS daily_top_category FROM (
  SELECT user_id, d, item_category,
         row_number() OVER (PARTITION BY user_id, d ORDER BY count(*) DESC, item_category) AS rn
  FROM ev GROUP BY user_id, d, item_category) t WHERE rn = 1""")
ORACLE_EXTRA["pct_rank_active_days"] = with_log("""
SELECT user_id, active_days,
       (rank() OVER (ORDER BY active_days) + CAST(count(*) OVER (PARTITION BY active_days) - 1 AS DOUBLE) / 2.0)
         / CAST(count(*) OVER () AS DOUBLE) AS pct_rank_active_days
FROM (SELECT user_id, count(DISTINCT d) AS active_days FROM ev GROUP BY user_id) a""")
DESCRIBE_ITEM_COLUMNS = ["total_behavior_cnt", "unique_user_cnt", "active_days", "item_lifetime_days",
                         "max_daily_behavior_cnt"]


def rnd(x: str, digits: int) -> str:
    scale = f"{10 ** digits}.0"
    return f"(round_even(({x}) * {scale}, 0) / {scale})"


ORACLE_EXTRA["describe_numeric"] = with_log(" UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS "column", count({c}) AS count,
       {rnd(f'avg(CAST({c} AS DOUBLE))', 6)} AS mean, {rnd(f'stddev_samp(CAST({c} AS DOUBLE))', 6)} AS std,
       CAST(min({c}) AS DOUBLE) AS min, {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 6)} AS q25,
       {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 6)} AS q50,
       {rnd(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 6)} AS q75,
       CAST(max({c}) AS DOUBLE) AS max FROM e_final"""
    for i, c in enumerate(DESCRIBE_ITEM_COLUMNS)), *entity_ctes("item_id"))


def top_null_columns_sql(columns: list[str], top: int = 20) -> str:
    counts = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in columns)
    pos = ", ".join(f"({i}, '{c}')" for i, c in enumerate(columns))
    body = f"""
, nc AS (SELECT {counts} FROM u_final),
long AS (UNPIVOT nc ON COLUMNS(*) INTO NAME "column" VALUE null_count),
pos AS (SELECT * FROM (VALUES {pos}) t(position, "column"))
SELECT CAST(p.position AS INTEGER) AS position, l."column", CAST(l.null_count AS BIGINT) AS null_count
FROM long l JOIN pos p ON l."column" = p."column"
ORDER BY null_count DESC, position LIMIT {top}"""
    sql = with_log("", *ALL_USER_CTES)
    return sql + body


def user_columns_sql(columns: list[str]) -> str:
    """A projection of the user table (used by operator-level queries)."""
    return user_sql(columns)


# ---------------------------------------------------------------------------
# Quality reports
# ---------------------------------------------------------------------------

_BEHAVIOR_COLS = [(1, "pv_cnt"), (2, "fav_cnt"), (3, "cart_cnt"), (4, "buy_cnt")]
_UNBOUNDED = {"pv_buy_ratio", "cart_buy_ratio", "fav_buy_ratio", "pv_cart_ratio", "buy_user_ratio"}


def _common_sql(key: str, prefix: str, columns: list[str]) -> list[tuple]:
    out = [
        (f"{prefix}1", "duplicate_keys", f"count(*) - count(DISTINCT {key})", None, "zero", "error"),
        (f"{prefix}2", "key_count", f"count(DISTINCT {key})", f"count(DISTINCT {key})", "equal", "error"),
        (f"{prefix}3", "total_behavior_cnt", "sum(total_behavior_cnt)", "count(*)", "equal", "error"),
    ]
    out += [(f"{prefix}4", col, f"sum({col})", f"count(*) FILTER (WHERE behavior_type = {code})", "equal", "error")
            for code, col in _BEHAVIOR_COLS]
    out += [(f"{prefix}5", f"null_count:{c}", f'count(*) FILTER (WHERE "{c}" IS NULL)', None, "info", "info")
            for c in columns]
    return out


def _describe_sql(check_id: str, name: str, expr: str | None = None) -> list[tuple]:
    x = expr or name
    rows = [("count", f"count({x})"), ("mean", f"round_even(avg({x}) * 1000000.0, 0) / 1000000.0"),
            ("std", f"round_even(stddev_samp({x}) * 1000000.0, 0) / 1000000.0"), ("min", f"min({x})"),
            ("q25", f"quantile_cont({x}, 0.25)"), ("q50", f"quantile_cont({x}, 0.5)"),
            ("q75", f"quantile_cont({x}, 0.75)"), ("max", f"max({x})")]
    return [(check_id, f"{metric}:{name}", value, None, "info", "info") for metric, value in rows]


def user_quality_specs() -> list[tuple]:
    from footfall.schemas import USER_COLUMNS, USER_RATE_COLUMNS

    non_numeric = {"first_behavior_time", "last_behavior_time", "user_maturity_stage"}
    numeric = [c for c in USER_COLUMNS if c not in non_numeric and not c.endswith("_flag")]
    specs = _common_sql("user_id", "U", USER_COLUMNS)
    for r in USER_RATE_COLUMNS:
        specs += [("U6", f"min:{r}", f"min({r})", None, "unit", "error"),
                  ("U6", f"max:{r}", f"max({r})", None, "unit", "error")]
    dev = "abs(user_buy_rate + user_cart_rate + user_fav_rate + user_pv_rate - 1.0)"
    specs += _describe_sql("U7", "rate_sum_deviation", dev)
    specs.append(("U7", "rate_sum_deviation_gt_0.001", f"count(*) FILTER (WHERE {dev} > 0.001)", None, "zero", "error"))
    specs += _describe_sql("U8", "user_lifetime_days")
    specs.append(("U8", "lifetime_lt_1", "count(*) FILTER (WHERE user_lifetime_days < 1)", None, "zero", "error"))
    neg = " + ".join(f"(CASE WHEN count(*) FILTER (WHERE {c} < 0) > 0 THEN 1 ELSE 0 END)" for c in numeric)
    specs.append(("U10", "negative_columns", neg, None, "zero", "error"))
    specs += [("U10", f"negative:{c}", f"count(*) FILTER (WHERE {c} < 0)", None, "zero", "error") for c in numeric]
    specs += [("U11", f"out_of_range:{r}", f"count(*) FILTER (WHERE {r} < 0 OR {r} > 1)", None, "zero", "error")
              for r in USER_RATE_COLUMNS]
    return specs


def entity_quality_specs(key: str) -> list[tuple]:
    from footfall.schemas import (CATEGORY_COLUMNS, CATEGORY_NON_NEGATIVE, CATEGORY_RATIO_COLUMNS, ITEM_COLUMNS,
                                  ITEM_NON_NEGATIVE, ITEM_RATIO_COLUMNS)

    is_item = key == "item_id"
    prefix = "I" if is_item else "C"
    columns = ITEM_COLUMNS if is_item else CATEGORY_COLUMNS
    ratios = ITEM_RATIO_COLUMNS if is_item else [c for c in CATEGORY_RATIO_COLUMNS if c != "top_item_ratio"]
    non_negative = ITEM_NON_NEGATIVE if is_item else CATEGORY_NON_NEGATIVE
    life = "item_lifetime_days" if is_item else "category_lifetime_days"
    specs = _common_sql(key, prefix, columns)
    for r in ratios:
        sev = "info" if r in _UNBOUNDED else "error"
        specs += [(f"{prefix}6", f"min:{r}", f"min({r})", None, "unit", sev),
                  (f"{prefix}6", f"max:{r}", f"max({r})", None, "unit", sev),
                  (f"{prefix}6", f"out_of_range:{r}", f"count(*) FILTER (WHERE {r} < 0 OR {r} > 1)", None, "zero", sev)]
    specs += [(f"{prefix}7", f"negative:{c}", f"count(*) FILTER (WHERE {c} < 0)", None, "zero", "error")
              for c in non_negative]
    specs += _describe_sql(f"{prefix}8", life)
    specs.append((f"{prefix}8", "lifetime_lt_1", f"count(*) FILTER (WHERE {life} < 1)", None, "zero", "error"))
    if not is_item:
        specs += _describe_sql("C9", "top_item_ratio")
        specs.append(("C9", "out_of_range:top_item_ratio",
                      "count(*) FILTER (WHERE top_item_ratio < 0 OR top_item_ratio > 1)", None, "zero", "error"))
    return specs


def _passed_sql(rule: str, s: str, f: str) -> str:
    return {"equal": f"coalesce({s} = {f}, false)", "zero": f"coalesce({f} = 0, false)",
            "unit": f"coalesce({f} >= 0 AND {f} <= 1, true)"}.get(rule, "true")


def quality_sql(table: str, table_cte: str, specs: list[tuple], source_ctes: list[str]) -> str:
    fcols = ", ".join(f"CAST({fe} AS DOUBLE) AS f{i}" for i, (_, _, fe, _, _, _) in enumerate(specs))
    scols = ", ".join(f"CAST({se} AS DOUBLE) AS s{i}" for i, (_, _, _, se, _, _) in enumerate(specs) if se)
    structs = []
    for i, (cid, metric, _, se, rule, sev) in enumerate(specs):
        s = f"s{i}" if se else "CAST(NULL AS DOUBLE)"
        f = f"f{i}"
        structs.append(
            f"struct_pack(\"table\" := '{table}', check_id := '{cid}', metric := '{metric}', source_value := {s}, "
            f"feature_value := {f}, diff := {s} - {f}, passed := {_passed_sql(rule, s, f)}, severity := '{sev}')")
    body = f"""
SELECT * FROM (
  SELECT UNNEST([{', '.join(structs)}], recursive := true)
  FROM (SELECT {fcols} FROM {table_cte}) fa CROSS JOIN (SELECT {scols} FROM clean) sa
) q WHERE NOT ((metric LIKE 'null_count:%' OR (check_id = 'U10' AND metric LIKE 'negative:%')) AND feature_value = 0)"""
    return with_log(body, *source_ctes)


def user_table_cte() -> str:
    from footfall.schemas import USER_COLUMNS
    return f"u_table AS ({select_columns(USER_COLUMNS, USER_DOUBLES, 'u_final')})"


def entity_table_cte(key: str) -> str:
    from footfall.schemas import CATEGORY_COLUMNS, ITEM_COLUMNS
    cols = ITEM_COLUMNS if key == "item_id" else CATEGORY_COLUMNS
    return f"e_table AS ({select_columns(cols, ENTITY_DOUBLES, 'e_final')})"


def quality_user_sql() -> str:
    return quality_sql("user", "u_table", user_quality_specs(), ALL_USER_CTES + [user_table_cte()])


def quality_entity_sql(key: str) -> str:
    name = "item" if key == "item_id" else "category"
    return quality_sql(name, "e_table", entity_quality_specs(key), entity_ctes(key) + [entity_table_cte(key)])


def reconcile_sql(key: str, table_ctes: list[str], table_cte: str) -> str:
    body = f"""
SELECT coalesce(s.{key}, t.{key}) AS {key}, s.source_total, s.source_pv_cnt, s.source_fav_cnt,
       s.source_cart_cnt, s.source_buy_cnt, t.total_behavior_cnt AS feature_total,
       t.pv_cnt AS feature_pv_cnt, t.fav_cnt AS feature_fav_cnt, t.cart_cnt AS feature_cart_cnt,
       t.buy_cnt AS feature_buy_cnt,
       coalesce(s.source_total = t.total_behavior_cnt AND s.source_pv_cnt = t.pv_cnt
                AND s.source_fav_cnt = t.fav_cnt AND s.source_cart_cnt = t.cart_cnt
                AND s.source_buy_cnt = t.buy_cnt, false) AS matched
FROM (SELECT {key}, count(*) AS source_total,
             count(*) FILTER (WHERE behavior_type = 1) AS source_pv_cnt,
             count(*) FILTER (WHERE behavior_type = 2) AS source_fav_cnt,
             count(*) FILTER (WHERE behavior_type = 3) AS source_cart_cnt,
             count(*) FILTER (WHERE behavior_type = 4) AS source_buy_cnt
      FROM clean GROUP BY {key}) s
FULL OUTER JOIN {table_cte} t ON s.{key} = t.{key}"""
    return with_log(body, *table_ctes)


def sampled_sql(key: str, table_ctes: list[str], table_cte: str, seed: int = 42) -> str:
    """The spot check: reconciliation of the entity with the smallest md5."""
    inner = reconcile_sql(key, table_ctes, table_cte)
    return f"SELECT * FROM ({inner}) r ORDER BY md5({key} || ':{seed}'), {key} LIMIT 1"


def describe_sql(table_ctes: list[str], table: str, columns: list[str]) -> str:
    """The eight statistics of every numeric column of a feature table."""
    rows = [f"""SELECT {i} AS position, '{c}' AS "column", count({c}) AS count, {rnd(f'avg({c})', 6)} AS mean,
       {rnd(f'stddev_samp({c})', 6)} AS std, CAST(min({c}) AS DOUBLE) AS min, {rnd(f'quantile_cont({c}, 0.25)', 6)} AS q25,
       {rnd(f'quantile_cont({c}, 0.5)', 6)} AS q50, {rnd(f'quantile_cont({c}, 0.75)', 6)} AS q75,
       CAST(max({c}) AS DOUBLE) AS max FROM {table}""" for i, c in enumerate(columns)]
    return with_log("\nUNION ALL\n".join(rows), *table_ctes)


def numeric_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if not c.endswith(("_flag", "_time")) and c != "user_maturity_stage"]


RAW_CSV_SQL = with_log("""
SELECT user_id, "timestamp", item_id, behavior_type,
       row_number() OVER (PARTITION BY user_id ORDER BY "timestamp", row_id) AS behavior_order
FROM clean""")
