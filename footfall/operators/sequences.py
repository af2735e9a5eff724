"""Sequence operators: event order, steps to buy, category shifts, as-of
view-before-buy matching and streaks.

No window here runs over an entity's raw events.  Event order is a prefix sum
over ordered parts: inside a (user, hour, part) of bounded size, across the parts
of one hour (a window over one summary row a part), and across the user's hours
(a window over the (user, hour) rollup, bounded by the hours observed, not by how
many events the user produced).  An hour of up to ``PART_ROWS`` events is one part; the
events of larger ones are dealt to ranges of (user, hour, row id), whatever
the ids look like.  The as-of match runs over the (user, item, hour) rollup for the
same reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import bit_flag, hours_between
from footfall.schemas import BUY, CART, FAV, PV
from footfall.session import reliable_checkpoint

_UNBOUNDED = Window.unboundedPreceding


# Events of a (user, hour) that one window partition may hold; more are dealt to ranges.
PART_ROWS = 1 << 20
# Crowded hours that a broadcast may list (some 16 MB); each has over PART_ROWS events.
CROWDED_HOURS = 1 << 19


def in_parts(events: DataFrame, hour_counts: DataFrame | None = None, part_rows: int = PART_ROWS,
             parts: int | None = None) -> DataFrame:
    """``events`` with ``part``, so that (user, hour, part) is a bounded run of the
    user's (time, row_id) order and parts ascend in that order.

    ``hour_counts``: (user_id, timestamp, n), from a rollup that exists anyway (counted here
    otherwise).  Usually no hour is crowded and every hour is part 0, without a further
    pass.  The events of crowded hours alone are range-partitioned by (user, hour,
    row id) into ``parts`` tasks and written, each task's rows being one part, so even
    a third of all events in one hour is spread over many tasks.  An event without a
    row id fails: it would give wrong orders."""
    key = ["user_id", "timestamp"]
    checked = events.withColumn("row_id", F.expr(
        "CASE WHEN row_id IS NULL THEN CAST(raise_error('event without row_id') AS BIGINT) ELSE row_id END"))
    if hour_counts is None:
        hour_counts = events.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    crowded = reliable_checkpoint(hour_counts.where(F.col("n") > part_rows).select(*key))
    n = crowded.count()
    if not n:
        return checked.withColumn("part", F.lit(0))
    listed = F.broadcast(crowded) if n <= CROWDED_HOURS else crowded
    order = [*key, "row_id"]
    within = checked.join(listed, key, "left_semi")
    within = within.repartitionByRange(parts, *order) if parts else within.repartitionByRange(*order)
    ranged = reliable_checkpoint(within.withColumn("part", F.spark_partition_id()))
    return checked.join(listed, key, "left_anti").withColumn("part", F.lit(0)).unionByName(ranged)


def within_part(parted: DataFrame) -> DataFrame:
    """Per event of :func:`in_parts`: 0-based position inside its (user, hour, part)
    and the previous event's category there (ties in time keep ``row_id`` order)."""
    w = Window.partitionBy("user_id", "timestamp", "part").orderBy("row_id")
    return parted.select(
        "row_id", "user_id", "item_id", "item_category", "behavior_type", "timestamp", "part",
        (F.row_number().over(w) - 1).alias("pos_in_part"),
        F.lag("item_category").over(w).alias("prev_cat_in_part"),
    )


def part_rollup(parted: DataFrame) -> DataFrame:
    """(user, hour, part) rollup with counts and in-part sequence statistics, plus
    what each part carries over from the hour's parts before it (a window over one
    row a part)."""
    bt = F.col("behavior_type")
    rolled = within_part(parted).groupBy("user_id", "timestamp", "part").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.count_if(bt == PV).cast("bigint").alias("pv"),
        F.count_if(bt == FAV).cast("bigint").alias("fav"),
        F.count_if(bt == CART).cast("bigint").alias("cart"),
        F.count_if(bt == BUY).cast("bigint").alias("buy"),
        F.bit_or(bit_flag(bt)).alias("bt_mask"),
        F.coalesce(F.sum(F.when(bt == BUY, F.col("pos_in_part"))), F.lit(0)).cast("bigint").alias("buy_pos"),
        F.count_if(F.col("item_category") != F.col("prev_cat_in_part")).cast("bigint").alias("shifts"),
        F.min_by("item_category", "row_id").alias("first_cat"),
        F.max_by("item_category", "row_id").alias("last_cat"),
    )
    w = Window.partitionBy("user_id", "timestamp").orderBy("part")
    return rolled.select(
        "*",
        F.coalesce(F.sum("n").over(w.rowsBetween(_UNBOUNDED, -1)), F.lit(0)).cast("bigint").alias("before_in_hour"),
        F.lag("last_cat").over(w).alias("prev_part_last_cat"),
    )


def user_hour_rollup(parted: DataFrame) -> DataFrame:
    """(user, hour) rollup with counts and within-hour sequence statistics,
    assembled from :func:`part_rollup` (no window over an unbounded group)."""
    b = part_rollup(parted)
    return b.groupBy("user_id", "timestamp").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("n", "pv", "fav", "cart", "buy")],
        F.bit_or("bt_mask").alias("bt_mask"),
        F.sum(F.col("buy") * F.col("before_in_hour") + F.col("buy_pos")).cast("bigint").alias("buy_pos_in_hour"),
        (F.sum("shifts") + F.count_if(F.col("first_cat") != F.col("prev_part_last_cat")))
        .cast("bigint").alias("shifts_in_hour"),
        F.min_by("first_cat", "part").alias("first_cat"),
        F.max_by("last_cat", "part").alias("last_cat"),
    )


def across_hours(uh: DataFrame) -> DataFrame:
    """Adds, per (user, hour): events and views in the user's earlier hours
    and the last category of the previous active hour."""
    w = Window.partitionBy("user_id").orderBy("timestamp")
    before = w.rowsBetween(_UNBOUNDED, -1)
    return uh.select(
        "*",
        F.coalesce(F.sum("n").over(before), F.lit(0)).cast("bigint").alias("events_before"),
        F.coalesce(F.sum("pv").over(before), F.lit(0)).cast("bigint").alias("views_before"),
        F.lag("last_cat").over(w).alias("prev_last_cat"),
    )


def sequence_aggregates(uh_seq: DataFrame) -> list:
    """Per-user aggregates over :func:`across_hours` output.

    * ``steps_sum``: over all buys, the number of the user's events before it
      (position - 1), so ``avg_steps_to_buy = steps_sum / buy``;
    * ``category_shift_cnt``: category changes between neighbouring events;
    * ``view_before_first_buy_cnt``: views in hours before the first buy hour
      (strictly earlier), 0 without a buy.
    """
    first_buy = F.min(F.when(F.col("buy") > 0, F.struct(F.col("timestamp").alias("ts"),
                                                          F.col("views_before").alias("views"))))
    return [
        F.sum(F.col("buy") * F.col("events_before") + F.col("buy_pos_in_hour")).cast("bigint").alias("steps_sum"),
        (F.sum("shifts_in_hour") + F.count_if(F.col("first_cat") != F.col("prev_last_cat")))
        .cast("bigint").alias("category_shift_cnt"),
        F.coalesce(first_buy["views"], F.lit(0)).cast("bigint").alias("view_before_first_buy_cnt"),
    ]


def event_order(parted: DataFrame) -> DataFrame:
    """1-based position of every event of :func:`in_parts` in its user's (time, row_id) order.

    Position = events in the user's earlier hours + events in earlier parts of the
    hour + position inside the part.  The first two come from counts per (user, hour,
    part), aggregated before their shuffle, as one offset for each part; the raw
    events are shuffled once, for the window inside the part, which has the join's
    partitioning too."""
    key = ["user_id", "timestamp", "part"]
    counts = parted.groupBy(*key).agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    in_hour = Window.partitionBy("user_id", "timestamp").orderBy("part").rowsBetween(_UNBOUNDED, -1)
    runs = counts.withColumn("before_in_hour", F.coalesce(F.sum("n").over(in_hour), F.lit(0)))
    earlier = Window.partitionBy("user_id").orderBy("timestamp").rowsBetween(_UNBOUNDED, -1)
    hours = (counts.groupBy("user_id", "timestamp").agg(F.sum("n").alias("n"))
             .select("user_id", "timestamp", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("events_before")))
    offsets = runs.join(hours, ["user_id", "timestamp"]).select(
        *key, (F.col("events_before") + F.col("before_in_hour")).alias("before"))
    inner = within_part(parted).select("row_id", *key, "pos_in_part")
    return (inner.join(offsets, key)
            .select("row_id", "user_id",
                    (F.col("before") + F.col("pos_in_part") + 1).cast("bigint").alias("behavior_order")))


def user_item_hour(uict: DataFrame) -> DataFrame:
    """(user, item, hour) -> views, buys, partitioned by (user, item).

    Rows per (user, item) are bounded by the hours observed, so the as-of
    window below never holds an unbounded group.
    """
    return (uict.repartition("user_id", "item_id")
            .groupBy("user_id", "item_id", "timestamp")
            .agg(F.sum("pv").cast("bigint").alias("pv"), F.sum("buy").cast("bigint").alias("buy")))


def last_view_before_buy(uit: DataFrame) -> DataFrame:
    """As-of backward match: for every distinct (user, item, buy hour) the
    last view of that item at or before it, and the gap in hours.

    A running ``max`` over the (user, item) rollup ordered by hour replaces a
    view x buy join, which would be quadratic for heavy users.
    """
    w = Window.partitionBy("user_id", "item_id").orderBy("timestamp").rowsBetween(_UNBOUNDED, 0)
    with_last = uit.select(
        "user_id", "item_id", "timestamp", "buy",
        F.max(F.when(F.col("pv") > 0, F.col("timestamp"))).over(w).alias("last_view_time"),
    )
    return with_last.where((F.col("buy") > 0) & F.col("last_view_time").isNotNull()).select(
        "user_id", "item_id", F.col("timestamp").alias("buy_time"), "last_view_time",
        hours_between("last_view_time", "timestamp").alias("pv_to_buy_hours"),
    )


def view_buy_pairs(uit: DataFrame) -> DataFrame:
    """Per (user, item): number of (view, buy) event pairs with view time <=
    buy time, counted with a running sum instead of emitting the pairs."""
    w = Window.partitionBy("user_id", "item_id").orderBy("timestamp").rowsBetween(_UNBOUNDED, 0)
    running = uit.select("user_id", "item_id", "buy", F.sum("pv").over(w).alias("views_so_far"))
    return (running.where(F.col("buy") > 0)
            .groupBy("user_id", "item_id")
            .agg(F.sum(F.col("buy") * F.col("views_so_far")).cast("bigint").alias("pair_cnt"))
            .where(F.col("pair_cnt") > 0))


def asof_aggregates(matched: DataFrame) -> DataFrame:
    """Per user: ``first_buy_interval`` (gap of the earliest matched buy, the
    smallest item on ties) and ``impulsive_buy_flag`` (a buy 0-1 h after a
    view of the same item; the nearest view decides)."""
    first = F.min(F.struct(F.col("buy_time").alias("t"), F.col("item_id").alias("i"),
                           F.col("pv_to_buy_hours").alias("h")))
    return matched.groupBy("user_id").agg(
        first["h"].alias("first_buy_interval"),
        F.bool_or(F.col("pv_to_buy_hours") <= 1).alias("impulsive_buy_flag"),
    )


def streaks(df: DataFrame, key: str, date: str = "date", state: str | None = None) -> DataFrame:
    """Gaps and islands over one row per (key, date): runs of consecutive
    days (with an unchanged ``state`` when given).  Returns (key, run, days).

    The window is over a per-day rollup, so a key has at most one row per
    observed day.
    """
    w = Window.partitionBy(key).orderBy(date)
    new_run = F.coalesce(F.datediff(F.col(date), F.lag(date).over(w)) != 1, F.lit(True))
    if state is not None:
        new_run = new_run | F.coalesce(F.col(state) != F.lag(state).over(w), F.lit(True))
    marked = df.select(key, date, new_run.cast("int").alias("new_run"))
    runs = marked.select(key, F.sum("new_run").over(w.rowsBetween(_UNBOUNDED, 0)).alias("run"))
    return runs.groupBy(key, "run").agg(F.count(F.lit(1)).cast("bigint").alias("days"))
