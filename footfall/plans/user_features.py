"""User feature table (100 columns, one row per user) and its families.

Physical shape (see README "Plans"):

1. Two rollups are built from the log and checkpointed: (user, hour) with
   within-hour / across-hour sequence statistics (the only shuffle of raw
   events) and (user, item, category, hour) (partially aggregated before its
   shuffle).  Every block reads one of them.
2. Five rollups feed almost every column: (user, hour) with sequence
   statistics, (user, day), (user, item), (user, category) and
   (user, day, category).  Distinct counts become row counts of a rollup.
3. Per-user windows run only over (user, hour) / (user, day) /
   (user, item, hour) rollups, bounded by the observed time span.
4. Blocks are joined on ``user_id``; every block is the output of a
   ``groupBy("user_id")``, so the joins are co-partitioned.
5. The assembled base is checkpointed to the shared checkpoint directory;
   17 thresholds are selected by interval refinement (one row, broadcast) and the
   four percentile ranks are histogram joins.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import bit_flag, day_span, flag, hours_between, round_half_even, safe_ratio, top_key
from footfall.operators import rollups as R
from footfall.operators import sequences as S
from footfall.operators.ranking import pct_ranks, ranked_histogram
from footfall.operators.thresholds import attach, thresholds
from footfall.schemas import HOUR_BANDS, USER_APPENDED, USER_ORDER
from footfall.session import reliable_checkpoint

KEY = "user_id"

# Thresholds (name -> column expression, quantile).
THRESHOLD_SPEC = {
    "q75_favorite_item_ratio": ("favorite_item_ratio", 0.75),
    "q75_category_diversity": ("category_diversity", 0.75),
    "q75_cart_cnt": ("cart_cnt", 0.75),
    "q75_category_shift_cnt": ("category_shift_cnt", 0.75),
    "q75_max_consecutive_active_days": ("max_consecutive_active_days", 0.75),
    "q75_active_days": ("active_days", 0.75),
    "q75_buy_cnt": ("buy_cnt", 0.75),
    "q75_cart_fav_cnt": ("cart_cnt + fav_cnt", 0.75),
    "q75_pv_buy_ratio": ("pv_buy_ratio", 0.75),
    "q75_pv_cnt": ("pv_cnt", 0.75),
    "q75_fav_cnt": ("fav_cnt", 0.75),
    "q75_user_lifetime_days": ("user_lifetime_days", 0.75),
    "q75_inactive_gap_days": ("inactive_gap_days", 0.75),
    "q25_user_lifetime_days": ("user_lifetime_days", 0.25),
    "q25_recent_7d_behavior_cnt": ("recent_7d_behavior_cnt", 0.25),
    "median_buy_cnt": ("buy_cnt", 0.5),
    "median_pv_buy_ratio": ("pv_buy_ratio", 0.5),
}

# The families, their columns, in the order of the feature
# catalogue.
FAMILIES = {
    "user_basic": ["total_behavior_cnt", "active_days", "behavior_type_cnt", "first_behavior_time",
                   "last_behavior_time", "active_hour_cnt", "pv_cnt", "fav_cnt", "cart_cnt", "buy_cnt"],
    "user_depth": ["avg_behavior_per_day", "max_daily_behavior_cnt", "min_daily_behavior_cnt",
                   "avg_behavior_per_item", "avg_behavior_per_category"],
    "user_conversion": ["user_buy_rate", "user_cart_rate", "user_fav_rate", "user_pv_rate",
                        "user_intent_score", "cart_buy_ratio", "fav_buy_ratio", "pv_buy_ratio",
                        "pv_to_cart_ratio", "hesitation_score"],
    "user_time_activity": ["user_lifetime_days", "late_night_behavior_cnt", "morning_behavior_cnt",
                           "afternoon_behavior_cnt", "evening_behavior_cnt", "morning_ratio",
                           "evening_ratio", "late_night_ratio", "weekend_behavior_cnt",
                           "weekday_behavior_cnt", "weekend_ratio", "peak_active_hour"],
    "user_time_slots": ["active_1h_slot", "active_2h_slot", "active_3h_slot", "active_6h_slot",
                        "peak_1h_slot", "peak_6h_slot"],
    "user_item_preference": ["item_diversity", "category_diversity", "viewed_item_cnt", "bought_item_cnt",
                             "cart_item_cnt", "fav_item_cnt", "repeat_view_item_cnt", "repeat_buy_item_cnt",
                             "top_item_id", "top_item_behavior_cnt", "favorite_item_ratio",
                             "repeat_buy_same_item_flag", "single_item_dependency_flag"],
    "user_category_preference": ["viewed_category_cnt", "bought_category_cnt", "cart_category_cnt",
                                 "fav_category_cnt", "top_category_id", "top_category_behavior_cnt",
                                 "top_category_behavior_ratio", "cross_category_user_flag"],
    "user_sequence": ["avg_steps_to_buy", "first_buy_interval", "avg_buy_interval",
                      "view_before_first_buy_cnt"],
    "user_hesitation": ["repeat_view_without_buy", "long_cart_no_buy_flag"],
    "user_category_shift": ["category_shift_cnt", "dominant_category_stability",
                            "cross_category_transition_flag"],
    "user_continuity": ["max_consecutive_active_days", "avg_consecutive_active_days",
                        "recent_3d_behavior_cnt", "recent_7d_behavior_cnt", "recent_3d_buy_cnt",
                        "recent_7d_buy_cnt", "inactive_gap_days", "active_streak_flag"],
    "user_value_flags": ["purchase_frequency", "repurchase_flag", "active_user_flag",
                         "high_value_user_flag", "potential_user_flag", "loyal_user_flag"],
    "user_conversion_flags": ["high_conversion_user_flag", "intent_user_flag", "low_conversion_flag",
                              "high_pv_low_buy_flag", "high_fav_low_buy_flag", "impulsive_buy_flag"],
    "user_lifecycle": ["new_user_flag", "mature_user_flag", "silent_user_flag", "churn_risk_flag",
                       "user_maturity_stage"],
    "user_retention_score": ["retention_score"],
}

# Families that need thresholds or ranks over all users.
_GLOBAL_FAMILIES = {"user_item_preference", "user_category_preference", "user_hesitation",
                    "user_category_shift", "user_continuity", "user_value_flags",
                    "user_conversion_flags", "user_lifecycle", "user_retention_score"}


def finish(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Final projection: column order, DOUBLE columns rounded half-to-even
    (``rint(x * 10^d) / 10^d``), as one SQL projection."""
    types = dict(df.dtypes)
    scale = f"{float(10 ** digits)!r}D"
    return df.selectExpr(*[
        f"rint(`{c}` * {scale}) / {scale} AS `{c}`" if types[c] == "double" else f"`{c}`" for c in columns
    ])


class UserFeatures:
    """Builds the user table from a clean LOG, block by block.

    Blocks are lazy DataFrames; nothing runs until an action, except the
    optional checkpoint of the assembled base before thresholds and ranks.
    """

    def __init__(self, log: DataFrame, exact_quantiles: bool = True, checkpoint: bool = True,
                 part_rows: int = S.PART_ROWS, sequences: bool = True):
        """``sequences=False``: the (user, hour) rollup has counts only, a plain
        aggregate of the log without any window over its events."""
        self.log = log
        self.sequences = sequences
        self.exact = exact_quantiles
        self.use_checkpoint = checkpoint
        self.part_rows = part_rows

    # ----- shared rollups -------------------------------------------------
    def _materialize(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """Checkpoint a rollup that several blocks read (shared checkpoint
        directory): every block then reads it instead of recomputing it from
        the log (column pruning would otherwise give each block its own scan
        and shuffle), and a lost executor does not send the job back to the
        log."""
        return reliable_checkpoint(df, by) if self.use_checkpoint else df

    @cached_property
    def events(self) -> DataFrame:
        return R.user_events(self.log)

    @cached_property
    def parted_events(self) -> DataFrame:
        """The events in bounded parts; the sizes of the hours come from a rollup, not
        from another pass over the log."""
        hours = self.uict.groupBy(KEY, "timestamp").agg(F.sum("n").alias("n"))
        return S.in_parts(self.events, hours, self.part_rows)

    @cached_property
    def user_hour(self) -> DataFrame:
        """(user, hour) rollup with within-hour and across-hour sequence
        columns: one exchange of the raw events on (user, hour, part),
        then exchanges of rollup rows only.  It is bucketed by user (a user has at most
        a row for each hour), so no block of it needs an exchange."""
        if not self.sequences:
            mask = F.bit_or(bit_flag("behavior_type")).alias("bt_mask")
            return self._materialize(self.events.groupBy(KEY, "timestamp").agg(*R.behavior_counts(), mask)
                                     .repartition(KEY), by=KEY)
        return self._materialize(S.across_hours(S.user_hour_rollup(self.parted_events)), by=KEY)

    @cached_property
    def uict(self) -> DataFrame:
        """(user, item, category, hour) rollup; partial aggregation before
        its shuffle."""
        return self._materialize(R.user_item_category_hour(self.events))

    @cached_property
    def user_day(self) -> DataFrame:
        uh = self.user_hour
        return uh.groupBy(KEY, F.to_date("timestamp").alias("date")).agg(
            F.sum("n").cast("bigint").alias("n"), F.sum("buy").cast("bigint").alias("buy"))

    @cached_property
    def end_date(self) -> DataFrame:
        """Observation end: the last date in the log (one row)."""
        return self.user_day.agg(F.max("date").alias("end_date"))

    @cached_property
    def user_item(self) -> DataFrame:
        return self.uict.groupBy(KEY, "item_id").agg(*R.sum_counts())

    @cached_property
    def user_category(self) -> DataFrame:
        return self.uict.groupBy(KEY, "item_category").agg(*R.sum_counts(("n", "pv", "fav", "cart", "buy")))

    @cached_property
    def user_item_hour(self) -> DataFrame:
        return S.user_item_hour(self.uict)

    # ----- blocks (one row per user) --------------------------------------
    @cached_property
    def hour_block(self) -> DataFrame:
        """Counts, times, hours of day, bands, slots, weekend and sequence
        statistics from the (user, hour) rollup."""
        uh = self.user_hour
        hour = F.hour("timestamp")
        aggs = [
            F.sum("n").cast("bigint").alias("total_behavior_cnt"),
            *[F.sum(c).cast("bigint").alias(f"{c}_cnt") for c in ("pv", "fav", "cart", "buy")],
            F.bit_count(F.bit_or("bt_mask")).cast("bigint").alias("behavior_type_cnt"),
            F.min("timestamp").alias("first_behavior_time"),
            F.max("timestamp").alias("last_behavior_time"),
            R.distinct_small(hour).alias("active_hour_cnt"),
            *[F.bit_count(R.slot_mask(hour, w)).cast("bigint").alias(f"active_{w}h_slot") for w in (2, 3, 6)],
            F.sum(F.when(F.weekday("timestamp") >= 5, F.col("n")).otherwise(F.lit(0))).cast("bigint")
            .alias("weekend_behavior_cnt"),
            F.min(F.when(F.col("buy") > 0, F.col("timestamp"))).alias("first_buy_time"),
            F.max(F.when(F.col("buy") > 0, F.col("timestamp"))).alias("last_buy_time"),
            *R.hour_of_day_counts("hour(`timestamp`)", "n"),
            *(S.sequence_aggregates(uh) if self.sequences else []),
        ]
        b = uh.groupBy(KEY).agg(*aggs)
        hours = [f"h{h}" for h in range(24)]
        bands = {name: F.expr(f"CAST({' + '.join(hours[start:end])} AS BIGINT)") for name, start, end in HOUR_BANDS}
        band_sql = {name: f"({' + '.join(hours[start:end])})" for name, start, end in HOUR_BANDS}
        return b.select(
            KEY, "total_behavior_cnt", "pv_cnt", "fav_cnt", "cart_cnt", "buy_cnt", "behavior_type_cnt",
            "first_behavior_time", "last_behavior_time", "active_hour_cnt",
            "active_2h_slot", "active_3h_slot", "active_6h_slot",
            "weekend_behavior_cnt",
            (F.col("total_behavior_cnt") - F.col("weekend_behavior_cnt")).alias("weekday_behavior_cnt"),
            R.argmax_first(hours).alias("peak_active_hour"),
            *[e.alias(name) for name, e in bands.items()],
            R.argmax_first([band_sql[name] for name, _, _ in HOUR_BANDS]).alias("peak_6h_slot"),
            *(("steps_sum", "category_shift_cnt", "view_before_first_buy_cnt") if self.sequences else ()),
            "first_buy_time", "last_buy_time",
        )

    @cached_property
    def day_block(self) -> DataFrame:
        """Active days, daily extremes, recency and streak statistics."""
        ud = attach(self.user_day, self.end_date)
        recent = {
            "recent_3d_behavior_cnt": (2, "n"), "recent_7d_behavior_cnt": (6, "n"),
            "recent_3d_buy_cnt": (2, "buy"), "recent_7d_buy_cnt": (6, "buy"),
        }
        days = ud.groupBy(KEY).agg(
            F.count(F.lit(1)).cast("bigint").alias("active_days"),
            F.max("n").cast("bigint").alias("max_daily_behavior_cnt"),
            F.min("n").cast("bigint").alias("min_daily_behavior_cnt"),
            *[F.sum(F.when(F.col("date") >= F.date_sub("end_date", back), F.col(c)).otherwise(F.lit(0)))
              .cast("bigint").alias(name) for name, (back, c) in recent.items()],
            F.datediff(F.max("end_date"), F.max("date")).cast("bigint").alias("inactive_gap_days"),
        )
        runs = S.streaks(self.user_day.select(KEY, "date"), KEY, "date")
        streak = runs.groupBy(KEY).agg(
            F.max("days").cast("bigint").alias("max_consecutive_active_days"),
            F.avg("days").alias("avg_consecutive_active_days"),
        )
        return days.join(streak, KEY, "left")

    @cached_property
    def item_block(self) -> DataFrame:
        ui = self.user_item
        return ui.groupBy(KEY).agg(
            F.count(F.lit(1)).cast("bigint").alias("item_diversity"),
            F.count_if(F.col("pv") > 0).cast("bigint").alias("viewed_item_cnt"),
            F.count_if(F.col("buy") > 0).cast("bigint").alias("bought_item_cnt"),
            F.count_if(F.col("cart") > 0).cast("bigint").alias("cart_item_cnt"),
            F.count_if(F.col("fav") > 0).cast("bigint").alias("fav_item_cnt"),
            F.count_if(F.col("pv") > 1).cast("bigint").alias("repeat_view_item_cnt"),
            F.count_if(F.col("buy") > 1).cast("bigint").alias("repeat_buy_item_cnt"),
            F.count_if((F.col("pv") > 1) & (F.col("buy") == 0)).cast("bigint").alias("repeat_view_without_buy"),
            top_key("item_id", "n").alias("top_item_id"),
            F.max("n").cast("bigint").alias("top_item_behavior_cnt"),
        )

    @cached_property
    def category_block(self) -> DataFrame:
        uc = self.user_category
        return uc.groupBy(KEY).agg(
            F.count(F.lit(1)).cast("bigint").alias("category_diversity"),
            F.count_if(F.col("pv") > 0).cast("bigint").alias("viewed_category_cnt"),
            F.count_if(F.col("buy") > 0).cast("bigint").alias("bought_category_cnt"),
            F.count_if(F.col("cart") > 0).cast("bigint").alias("cart_category_cnt"),
            F.count_if(F.col("fav") > 0).cast("bigint").alias("fav_category_cnt"),
            top_key("item_category", "n").alias("top_category_id"),
            F.max("n").cast("bigint").alias("top_category_behavior_cnt"),
        )

    @cached_property
    def daily_top_category(self) -> DataFrame:
        """(user, date) -> the day's most frequent category (smallest on ties)."""
        udc = self.uict.groupBy(KEY, F.to_date("timestamp").alias("date"), "item_category").agg(
            F.sum("n").cast("bigint").alias("n"))
        return udc.groupBy(KEY, "date").agg(top_key("item_category", "n").alias("daily_top_category"))

    @cached_property
    def category_streak_block(self) -> DataFrame:
        runs = S.streaks(self.daily_top_category, KEY, "date", state="daily_top_category")
        return runs.groupBy(KEY).agg(F.max("days").cast("bigint").alias("dominant_category_stability"))

    @cached_property
    def last_view_before_buy(self) -> DataFrame:
        return S.last_view_before_buy(self.user_item_hour)

    @cached_property
    def asof_block(self) -> DataFrame:
        return S.asof_aggregates(self.last_view_before_buy)

    # ----- assembly ------------------------------------------------------
    # Blocks needed by the families that use no global statistic.
    FAMILY_BLOCKS = {
        "user_basic": ("day_block",),
        "user_depth": ("day_block", "item_block", "category_block"),
        "user_conversion": (),
        "user_time_activity": (),
        "user_time_slots": (),
        "user_sequence": ("asof_block",),
    }
    # Families that need no order of events.
    COUNT_FAMILIES = frozenset(FAMILY_BLOCKS) - {"user_sequence"}
    ALL_BLOCKS = ("day_block", "item_block", "category_block", "category_streak_block", "asof_block")

    @staticmethod
    def _derived() -> dict[str, tuple[tuple[str, ...], Column]]:
        """Derived column -> (input columns, expression)."""
        c = F.col
        n = "total_behavior_cnt"

        def ratio(num, den):
            return (num, den), safe_ratio(num, den)

        return {
            "avg_behavior_per_day": ratio(n, "active_days"),
            "avg_behavior_per_item": ratio(n, "item_diversity"),
            "avg_behavior_per_category": ratio(n, "category_diversity"),
            "user_buy_rate": ratio("buy_cnt", n),
            "user_cart_rate": ratio("cart_cnt", n),
            "user_fav_rate": ratio("fav_cnt", n),
            "user_pv_rate": ratio("pv_cnt", n),
            "user_intent_score": (("buy_cnt", "cart_cnt", "pv_cnt"),
                                  safe_ratio(c("buy_cnt") + c("cart_cnt"), "pv_cnt")),
            "cart_buy_ratio": ratio("buy_cnt", "cart_cnt"),
            "fav_buy_ratio": ratio("buy_cnt", "fav_cnt"),
            "pv_buy_ratio": ratio("buy_cnt", "pv_cnt"),
            "pv_to_cart_ratio": ratio("cart_cnt", "pv_cnt"),
            "hesitation_score": ratio("pv_cnt", "buy_cnt"),
            "user_lifetime_days": (("first_behavior_time", "last_behavior_time"),
                                   day_span("first_behavior_time", "last_behavior_time")),
            "morning_ratio": ratio("morning_behavior_cnt", n),
            "evening_ratio": ratio("evening_behavior_cnt", n),
            "late_night_ratio": ratio("late_night_behavior_cnt", n),
            "weekend_ratio": ratio("weekend_behavior_cnt", n),
            "active_1h_slot": (("active_hour_cnt",), c("active_hour_cnt")),
            "peak_1h_slot": (("peak_active_hour",), c("peak_active_hour")),
            "favorite_item_ratio": ratio("top_item_behavior_cnt", n),
            "top_category_behavior_ratio": ratio("top_category_behavior_cnt", n),
            "repeat_buy_same_item_flag": (("repeat_buy_item_cnt",), flag(c("repeat_buy_item_cnt") > 0)),
            "repurchase_flag": (("repeat_buy_item_cnt",), flag(c("repeat_buy_item_cnt") > 0)),
            "purchase_frequency": ratio("buy_cnt", "active_days"),
            "avg_steps_to_buy": ratio("steps_sum", "buy_cnt"),
            "avg_buy_interval": (("buy_cnt", "first_buy_time", "last_buy_time"),
                                 F.when(c("buy_cnt") >= 2, hours_between("first_buy_time", "last_buy_time")
                                        / (c("buy_cnt") - 1).cast("double"))),
            "impulsive_buy_flag": (("impulsive_buy_flag",), flag(c("impulsive_buy_flag"))),
        }

    def assemble(self, blocks: tuple[str, ...]) -> DataFrame:
        """``hour_block`` left-joined with the named blocks on ``user_id``
        (every block is one row per user), plus the derived columns whose
        inputs are present."""
        joined = self.hour_block
        for b in blocks:
            joined = joined.join(getattr(self, b), KEY, "left")
        present = set(joined.columns)
        derived = {name: expr for name, (inputs, expr) in self._derived().items() if set(inputs) <= present}
        return joined.withColumns(derived)

    @cached_property
    def base(self) -> DataFrame:
        """All per-user columns that need no global statistic (unrounded)."""
        return self.assemble(self.ALL_BLOCKS)

    def materialized_base(self) -> DataFrame:
        """The base, written to the shared checkpoint directory when enabled:
        thresholds, ranks and the final projection then read it instead of
        recomputing every rollup, and a lost executor does not send the job
        back to the raw log."""
        if self.use_checkpoint:
            return reliable_checkpoint(self.base)
        return self.base

    # The columns ranked for the retention score.
    RANKED = {"active_days": "_r_active", "max_consecutive_active_days": "_r_streak",
              "recent_7d_behavior_cnt": "_r_recent", "inactive_gap_days": "_r_gap"}

    @cached_property
    def flagged(self) -> DataFrame:
        """Base + thresholds, flags, lifecycle stage and retention score.

        The ranked histogram of the four percentile ranks has one row per column
        and distinct count; the thresholds need no histogram."""
        base = self.materialized_base()
        # Materialized because four rank joins read it.
        hist = self._materialize(ranked_histogram(base, [F.col(c) for c in self.RANKED]))
        spec = {name: (F.expr(expr), p) for name, (expr, p) in THRESHOLD_SPEC.items()}
        df = attach(base, thresholds(base, spec, exact=self.exact))
        # The flag rules (column >= / <= threshold), as SQL;
        # a comparison with an undefined value is False.
        potential = "cart_cnt + fav_cnt >= q75_cart_fav_cnt AND buy_cnt <= median_buy_cnt"
        rules = {
            "single_item_dependency_flag": "favorite_item_ratio >= q75_favorite_item_ratio",
            "cross_category_user_flag": "category_diversity >= q75_category_diversity",
            "long_cart_no_buy_flag": "cart_cnt >= q75_cart_cnt AND buy_cnt = 0",
            "cross_category_transition_flag": "category_shift_cnt >= q75_category_shift_cnt",
            "active_streak_flag": "max_consecutive_active_days >= q75_max_consecutive_active_days",
            "active_user_flag": "active_days >= q75_active_days",
            "high_value_user_flag": "buy_cnt >= q75_buy_cnt",
            "potential_user_flag": potential,
            "loyal_user_flag": "buy_cnt >= q75_buy_cnt AND active_days >= q75_active_days",
            "high_conversion_user_flag": "pv_buy_ratio >= q75_pv_buy_ratio",
            "intent_user_flag": potential,
            "low_conversion_flag": "pv_cnt >= q75_pv_cnt AND pv_buy_ratio <= median_pv_buy_ratio",
            "high_pv_low_buy_flag": "pv_cnt >= q75_pv_cnt AND buy_cnt <= median_buy_cnt",
            "high_fav_low_buy_flag": "fav_cnt >= q75_fav_cnt AND buy_cnt <= median_buy_cnt",
            "new_user_flag": "user_lifetime_days <= q25_user_lifetime_days",
            "mature_user_flag": "user_lifetime_days >= q75_user_lifetime_days AND active_days >= q75_active_days",
            "silent_user_flag": "inactive_gap_days >= q75_inactive_gap_days",
            "churn_risk_flag": ("recent_7d_behavior_cnt <= q25_recent_7d_behavior_cnt"
                                " AND inactive_gap_days >= q75_inactive_gap_days"),
        }
        df = df.withColumns({name: F.expr(f"coalesce({rule}, false)") for name, rule in rules.items()})
        df = df.withColumn("user_maturity_stage", F.expr(
            "CASE WHEN new_user_flag THEN 'new_user' WHEN mature_user_flag THEN 'mature_user' "
            "WHEN silent_user_flag THEN 'silent_user' WHEN churn_risk_flag THEN 'churn_risk_user' "
            "ELSE 'normal_user' END"))
        return self._with_retention(df, hist)

    def _with_retention(self, df: DataFrame, hist: DataFrame) -> DataFrame:
        df = pct_ranks(df, self.RANKED, hist=hist, index={c: i for i, c in enumerate(self.RANKED)})
        c = F.col
        score = (F.lit(0.35) * c("_r_active") + F.lit(0.25) * c("_r_streak")
                 + F.lit(0.25) * c("_r_recent") + F.lit(0.15) * (F.lit(1.0) - c("_r_gap"))) * F.lit(100.0)
        return df.withColumn("retention_score", round_half_even(score, 2))

    # ----- outputs -------------------------------------------------------
    def family(self, name: str) -> DataFrame:
        cols = [KEY] + FAMILIES[name]
        if name in _GLOBAL_FAMILIES:
            return finish(self.flagged, cols)
        return finish(self.assemble(self.FAMILY_BLOCKS[name]), cols)

    def table(self) -> DataFrame:
        return finish(self.flagged, USER_ORDER + USER_APPENDED)

    def thresholds(self) -> DataFrame:
        spec = {name: (F.expr(expr), p) for name, (expr, p) in THRESHOLD_SPEC.items()}
        return thresholds(self.materialized_base(), spec, exact=self.exact)


def user_feature_table(log: DataFrame, **kwargs) -> DataFrame:
    return UserFeatures(log, **kwargs).table()
