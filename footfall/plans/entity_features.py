"""Item and category feature tables (27 and 31 columns), one parametrised
builder for both.

Hot entities (an item or category holding a large share of all events) are
handled by two-level aggregation: the log is first rolled up by
(entity, user) and (entity, hour), which spreads a hot key over its users and
hours and pre-aggregates map-side; the per-entity aggregates then run over
those rollups, again with a partial step.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import day_span, round_half_even, safe_ratio
from footfall.operators import rollups as R
from footfall.schemas import CATEGORY_COLUMNS, ITEM_COLUMNS

# Families and their columns; ``{life}`` is the entity's
# lifetime column name.
FAMILY_COLUMNS = {
    "basic": ["total_behavior_cnt", "unique_user_cnt", "unique_item_cnt", "active_days",
              "first_behavior_time", "last_behavior_time", "pv_cnt", "fav_cnt", "cart_cnt", "buy_cnt"],
    "depth": ["avg_behavior_per_user", "avg_behavior_per_item", "avg_daily_behavior_cnt",
              "max_daily_behavior_cnt", "min_daily_behavior_cnt"],
    "conversion": ["pv_buy_ratio", "cart_buy_ratio", "fav_buy_ratio", "pv_cart_ratio"],
    "audience": ["unique_view_user_cnt", "unique_buy_user_cnt", "buy_user_ratio"],
    "time": ["{life}", "peak_active_hour", "weekend_behavior_cnt", "weekend_behavior_ratio",
             "late_night_behavior_cnt", "late_night_behavior_ratio"],
    "concentration": ["top_item_behavior_cnt", "top_item_ratio"],
}

ENTITIES = {
    "item_id": {"prefix": "item", "life": "item_lifetime_days", "columns": ITEM_COLUMNS},
    "item_category": {"prefix": "category", "life": "category_lifetime_days", "columns": CATEGORY_COLUMNS},
}


class EntityFeatures:
    def __init__(self, log: DataFrame, key: str):
        if key not in ENTITIES:
            raise ValueError(f"unknown entity key {key!r}")
        self.log = log
        self.key = key
        self.spec = ENTITIES[key]

    @cached_property
    def events(self) -> DataFrame:
        return R.enrich(self.log).select("user_id", "item_id", "item_category", "behavior_type", "timestamp")

    @cached_property
    def by_user(self) -> DataFrame:
        """(entity, user) -> n, pv, fav, cart, buy."""
        return self.events.groupBy(self.key, "user_id").agg(*R.behavior_counts())

    @cached_property
    def by_hour(self) -> DataFrame:
        """(entity, hour timestamp) -> n."""
        return self.events.groupBy(self.key, "timestamp").agg(F.count(F.lit(1)).cast("bigint").alias("n"))

    @cached_property
    def audience_block(self) -> DataFrame:
        return self.by_user.groupBy(self.key).agg(
            *R.sum_counts(),
            F.count(F.lit(1)).cast("bigint").alias("unique_user_cnt"),
            F.count_if(F.col("pv") > 0).cast("bigint").alias("unique_view_user_cnt"),
            F.count_if(F.col("buy") > 0).cast("bigint").alias("unique_buy_user_cnt"),
        )

    @cached_property
    def time_block(self) -> DataFrame:
        hour = F.hour("timestamp")
        b = self.by_hour.groupBy(self.key).agg(
            F.min("timestamp").alias("first_behavior_time"),
            F.max("timestamp").alias("last_behavior_time"),
            F.sum(F.when(F.weekday("timestamp") >= 5, F.col("n")).otherwise(F.lit(0))).cast("bigint")
            .alias("weekend_behavior_cnt"),
            F.sum(F.when(hour < 6, F.col("n")).otherwise(F.lit(0))).cast("bigint").alias("late_night_behavior_cnt"),
            *R.hour_of_day_counts("hour(`timestamp`)", "n"),
        )
        return b.select(
            self.key, "first_behavior_time", "last_behavior_time", "weekend_behavior_cnt",
            "late_night_behavior_cnt", R.argmax_first([f"h{h}" for h in range(24)]).alias("peak_active_hour"),
        )

    @cached_property
    def day_block(self) -> DataFrame:
        daily = self.by_hour.groupBy(self.key, F.to_date("timestamp").alias("date")).agg(
            F.sum("n").cast("bigint").alias("n"))
        return daily.groupBy(self.key).agg(
            F.count(F.lit(1)).cast("bigint").alias("active_days"),
            F.max("n").cast("bigint").alias("max_daily_behavior_cnt"),
            F.min("n").cast("bigint").alias("min_daily_behavior_cnt"),
        )

    @cached_property
    def item_block(self) -> DataFrame:
        """Categories only: distinct items and the top item's event count."""
        per_item = self.events.groupBy(self.key, "item_id").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
        return per_item.groupBy(self.key).agg(
            F.count(F.lit(1)).cast("bigint").alias("unique_item_cnt"),
            F.max("n").cast("bigint").alias("top_item_behavior_cnt"),
        )

    @cached_property
    def base(self) -> DataFrame:
        k = self.key
        df = self.audience_block.join(self.time_block, k, "left").join(self.day_block, k, "left")
        is_category = k == "item_category"
        if is_category:
            df = df.join(self.item_block, k, "left")
        df = df.withColumnRenamed("n", "total_behavior_cnt")
        for c in ("pv", "fav", "cart", "buy"):
            df = df.withColumnRenamed(c, f"{c}_cnt")
        n = F.col("total_behavior_cnt")
        derived = {
            "avg_behavior_per_user": safe_ratio(n, "unique_user_cnt"),
            "avg_daily_behavior_cnt": safe_ratio(n, "active_days"),
            "pv_buy_ratio": safe_ratio("buy_cnt", "pv_cnt"),
            "cart_buy_ratio": safe_ratio("buy_cnt", "cart_cnt"),
            "fav_buy_ratio": safe_ratio("buy_cnt", "fav_cnt"),
            "pv_cart_ratio": safe_ratio("cart_cnt", "pv_cnt"),
            "buy_user_ratio": safe_ratio("unique_buy_user_cnt", "unique_view_user_cnt"),
            self.spec["life"]: day_span("first_behavior_time", "last_behavior_time"),
            "weekend_behavior_ratio": safe_ratio("weekend_behavior_cnt", n),
            "late_night_behavior_ratio": safe_ratio("late_night_behavior_cnt", n),
        }
        if is_category:
            derived["avg_behavior_per_item"] = safe_ratio(n, "unique_item_cnt")
            derived["top_item_ratio"] = safe_ratio("top_item_behavior_cnt", n)
        return df.withColumns(derived)

    def _finish(self, columns: list[str]) -> DataFrame:
        from footfall.plans.user_features import finish

        return finish(self.base, columns)

    def family_columns(self, family: str) -> list[str]:
        allowed = set(self.spec["columns"])
        cols = [c.format(life=self.spec["life"]) for c in FAMILY_COLUMNS[family]]
        return [self.key] + [c for c in cols if c in allowed]

    def family(self, family: str) -> DataFrame:
        return self._finish(self.family_columns(family))

    def table(self) -> DataFrame:
        return self._finish(self.spec["columns"])


def item_feature_table(log: DataFrame) -> DataFrame:
    return EntityFeatures(log, "item_id").table()


def category_feature_table(log: DataFrame) -> DataFrame:
    return EntityFeatures(log, "item_category").table()
