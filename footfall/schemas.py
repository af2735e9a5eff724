"""Canonical schemas and fixed column lists.

The column names and their order are fixed values that must equal the
behaviour being reproduced; they are listed here together, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Raw log as read: every business column is text; coercion is a visible later
# step.  ``row_id`` is the source order and breaks ties between events of the
# same user in the same hour.
RAW_COLUMNS = ["user_id", "item_id", "behavior_type", "item_category", "time"]

RAW = T.StructType(
    [T.StructField("row_id", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in RAW_COLUMNS]
)

# Clean behaviour log.
LOG = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("behavior_type", T.IntegerType()),
    T.StructField("item_category", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# Behaviour codes and their names.
BEHAVIOR_CODES = {1: "pv", 2: "fav", 3: "cart", 4: "buy"}
PV, FAV, CART, BUY = 1, 2, 3, 4

# Text tokens that the reference's CSV reader turns into missing
# values (case-sensitive).
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Hour bands [start, end) of the time-of-day features.
HOUR_BANDS = [
    ("late_night_behavior_cnt", 0, 6),
    ("morning_behavior_cnt", 6, 12),
    ("afternoon_behavior_cnt", 12, 18),
    ("evening_behavior_cnt", 18, 24),
]

# Final column order of the user feature table (97 ordered
# columns; three more are appended after them).
USER_ORDER = [
    "user_id", "total_behavior_cnt", "pv_cnt", "fav_cnt", "cart_cnt", "buy_cnt",
    "active_days", "behavior_type_cnt",
    "avg_behavior_per_day", "avg_behavior_per_item", "avg_behavior_per_category",
    "max_daily_behavior_cnt", "min_daily_behavior_cnt",
    "user_buy_rate", "user_cart_rate", "user_fav_rate", "user_pv_rate",
    "user_intent_score", "cart_buy_ratio", "fav_buy_ratio", "pv_buy_ratio",
    "pv_to_cart_ratio",
    "first_behavior_time", "last_behavior_time", "user_lifetime_days",
    "active_hour_cnt", "peak_active_hour", "late_night_behavior_cnt",
    "morning_behavior_cnt", "afternoon_behavior_cnt", "evening_behavior_cnt",
    "morning_ratio", "evening_ratio", "late_night_ratio",
    "weekend_behavior_cnt", "weekday_behavior_cnt", "weekend_ratio",
    "active_1h_slot", "active_2h_slot", "active_3h_slot", "active_6h_slot",
    "peak_1h_slot", "peak_6h_slot",
    "max_consecutive_active_days", "avg_consecutive_active_days",
    "recent_3d_behavior_cnt", "recent_7d_behavior_cnt", "recent_3d_buy_cnt",
    "recent_7d_buy_cnt", "inactive_gap_days", "active_streak_flag",
    "viewed_item_cnt", "bought_item_cnt", "cart_item_cnt", "fav_item_cnt",
    "item_diversity", "repeat_view_item_cnt", "repeat_buy_item_cnt",
    "top_item_behavior_cnt", "top_item_id", "favorite_item_ratio",
    "repeat_buy_same_item_flag", "single_item_dependency_flag",
    "viewed_category_cnt", "bought_category_cnt", "cart_category_cnt",
    "fav_category_cnt", "category_diversity", "top_category_id",
    "top_category_behavior_cnt", "top_category_behavior_ratio",
    "category_shift_cnt", "dominant_category_stability",
    "cross_category_transition_flag", "cross_category_user_flag",
    "purchase_frequency", "repurchase_flag", "loyal_user_flag",
    "high_value_user_flag", "potential_user_flag", "active_user_flag",
    "high_conversion_user_flag", "intent_user_flag", "impulsive_buy_flag",
    "low_conversion_flag", "hesitation_score", "view_before_first_buy_cnt",
    "repeat_view_without_buy", "long_cart_no_buy_flag", "high_pv_low_buy_flag",
    "high_fav_low_buy_flag",
    "new_user_flag", "mature_user_flag", "silent_user_flag", "churn_risk_flag",
    "user_maturity_stage", "retention_score",
]
USER_APPENDED = ["avg_steps_to_buy", "first_buy_interval", "avg_buy_interval"]
USER_COLUMNS = USER_ORDER + USER_APPENDED

# Column order of the item table (creation order).
ITEM_COLUMNS = [
    "item_id", "total_behavior_cnt", "unique_user_cnt", "active_days",
    "first_behavior_time", "last_behavior_time",
    "pv_cnt", "fav_cnt", "cart_cnt", "buy_cnt",
    "avg_behavior_per_user", "avg_daily_behavior_cnt",
    "max_daily_behavior_cnt", "min_daily_behavior_cnt",
    "pv_buy_ratio", "cart_buy_ratio", "fav_buy_ratio", "pv_cart_ratio",
    "unique_view_user_cnt", "unique_buy_user_cnt", "buy_user_ratio",
    "item_lifetime_days", "peak_active_hour",
    "weekend_behavior_cnt", "weekend_behavior_ratio",
    "late_night_behavior_cnt", "late_night_behavior_ratio",
]

# Column order of the category table (creation order).
CATEGORY_COLUMNS = [
    "item_category", "total_behavior_cnt", "unique_user_cnt", "unique_item_cnt",
    "active_days", "first_behavior_time", "last_behavior_time",
    "pv_cnt", "fav_cnt", "cart_cnt", "buy_cnt",
    "avg_behavior_per_user", "avg_behavior_per_item", "avg_daily_behavior_cnt",
    "max_daily_behavior_cnt", "min_daily_behavior_cnt",
    "pv_buy_ratio", "cart_buy_ratio", "fav_buy_ratio", "pv_cart_ratio",
    "unique_view_user_cnt", "unique_buy_user_cnt", "buy_user_ratio",
    "category_lifetime_days", "peak_active_hour",
    "weekend_behavior_cnt", "weekend_behavior_ratio",
    "late_night_behavior_cnt", "late_night_behavior_ratio",
    "top_item_behavior_cnt", "top_item_ratio",
]

# Columns checked by the quality report.
USER_RATE_COLUMNS = ["user_buy_rate", "user_cart_rate", "user_fav_rate", "user_pv_rate"]
ITEM_RATIO_COLUMNS = [
    "pv_buy_ratio", "cart_buy_ratio", "fav_buy_ratio", "pv_cart_ratio",
    "buy_user_ratio", "weekend_behavior_ratio", "late_night_behavior_ratio",
]
CATEGORY_RATIO_COLUMNS = ITEM_RATIO_COLUMNS + ["top_item_ratio"]
ITEM_NON_NEGATIVE = [
    "total_behavior_cnt", "unique_user_cnt", "active_days", "pv_cnt", "fav_cnt",
    "cart_cnt", "buy_cnt", "avg_behavior_per_user", "avg_daily_behavior_cnt",
    "max_daily_behavior_cnt", "min_daily_behavior_cnt", "unique_view_user_cnt",
    "unique_buy_user_cnt", "item_lifetime_days", "weekend_behavior_cnt",
    "late_night_behavior_cnt",
]
CATEGORY_NON_NEGATIVE = [
    "total_behavior_cnt", "unique_user_cnt", "unique_item_cnt", "active_days",
    "pv_cnt", "fav_cnt", "cart_cnt", "buy_cnt", "avg_behavior_per_user",
    "avg_behavior_per_item", "avg_daily_behavior_cnt", "max_daily_behavior_cnt",
    "min_daily_behavior_cnt", "unique_view_user_cnt", "unique_buy_user_cnt",
    "category_lifetime_days", "weekend_behavior_cnt", "late_night_behavior_cnt",
    "top_item_behavior_cnt",
]
