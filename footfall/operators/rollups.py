"""Enrichment and rollups of the clean log.

Every per-entity feature is computed from a rollup, never from a window over
an entity's raw events: ``groupBy`` plans a partial (map-side) aggregate, so a
user or item holding a third of all rows still reaches the shuffle as one
partial row per task.  Rollups keyed by (entity, hour) or (entity, day) have a
row count per entity bounded by the observed time span, which is what makes
the later per-entity windows safe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import bit_flag, slot
from footfall.schemas import BUY, CART, FAV, PV


def enrich(log: DataFrame) -> DataFrame:
    """LOG plus ``date``, ``hour`` (0-23) and ``weekday`` (0 = Monday)."""
    ts = F.col("timestamp")
    return log.withColumns({
        "date": F.to_date(ts),
        "hour": F.hour(ts),
        "weekday": F.weekday(ts),
    })


def behavior_counts(code: str | Column = "behavior_type") -> list[Column]:
    """Aggregates ``n, pv, fav, cart, buy`` over raw events."""
    c = F.col(code) if isinstance(code, str) else code
    per = {name: F.count_if(c == v) for name, v in (("pv", PV), ("fav", FAV), ("cart", CART), ("buy", BUY))}
    return [F.count(F.lit(1)).cast("bigint").alias("n")] + [e.cast("bigint").alias(k) for k, e in per.items()]


def sum_counts(names: tuple[str, ...] = ("n", "pv", "fav", "cart", "buy")) -> list[Column]:
    """Re-aggregate count columns of a finer rollup."""
    return [F.sum(n).cast("bigint").alias(n) for n in names]


def user_events(log: DataFrame) -> DataFrame:
    """The columns of the log that the user features read."""
    return log.select("row_id", "user_id", "item_id", "item_category", "behavior_type", "timestamp")


def user_item_category_hour(events: DataFrame) -> DataFrame:
    """(user, item, category, hour) -> n, pv, fav, cart, buy (partial
    aggregation before the shuffle)."""
    return events.groupBy("user_id", "item_id", "item_category", "timestamp").agg(*behavior_counts())


def hour_of_day_counts(hour: str, n: str) -> list[Column]:
    """24 aggregates ``h0..h23``: events per hour of day (``hour`` and ``n``
    are SQL expressions)."""
    return [F.expr(f"CAST(sum(CASE WHEN {hour} = {h} THEN {n} ELSE 0 END) AS BIGINT) AS h{h}") for h in range(24)]


def argmax_first(values: list[str]) -> Column:
    """Index of the largest of the SQL expressions ``values``, the smallest
    index on ties."""
    top = f"greatest({', '.join(values)})"
    cases = " ".join(f"WHEN {v} = {top} THEN {i}" for i, v in enumerate(values))
    return F.expr(f"CASE {cases} END")


def distinct_small(values: Column) -> Column:
    """Aggregate: number of distinct values in 0..62 (bit mask, no Expand)."""
    return F.bit_count(F.bit_or(bit_flag(values))).cast("bigint")


def slot_mask(hour: Column, width: int) -> Column:
    return F.bit_or(bit_flag(slot(hour, width)))
