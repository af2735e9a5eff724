"""Reconciliation of feature tables with the log.

A report is one aggregate over the feature table and one over a rollup of the log (one
row per key, from one pass), each a single row, joined and unpivoted into check rows:

``(table, check_id, metric, source_value, feature_value, diff, passed, severity)``

``rule`` decides ``passed``: ``equal`` (log value = table value), ``zero``
(table value is 0), ``unit`` (table value inside [0, 1]; missing counts as
inside) or ``info`` (always passed; reported for reading).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.selection import as_columns, exact_quantiles
from footfall.schemas import BUY, CART, FAV, PV

BEHAVIOR_COLUMNS = {PV: "pv_cnt", FAV: "fav_cnt", CART: "cart_cnt", BUY: "buy_cnt"}


@dataclass(frozen=True)
class Check:
    """``feature`` is an aggregate over the table, with ``per_key`` over one row per key of it
    (columns ``key_rows`` and ``key_present``).  ``source`` is an aggregate over
    :func:`log_rollup`.  ``quantile`` = p makes ``feature`` a value per row of which
    the exact quantile is taken."""

    check_id: str
    metric: str
    feature: Column
    source: Column | None = None
    rule: str = "equal"
    severity: str = "error"
    per_key: bool = False
    quantile: float | None = None


def _per_key(df: DataFrame, key: str) -> DataFrame:
    """One narrow row per key: a distinct count among the other aggregates would
    shuffle all their buffers by key."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows")).select(
        "key_rows", F.col(key).isNotNull().cast("int").alias("key_present"))


def log_rollup(log: DataFrame, key: str) -> DataFrame:
    """One row per key with its events by behaviour: every value that a report or the
    reconciliation takes from the log adds up from it (partial aggregation in the tasks)."""
    bt = F.col("behavior_type")
    return log.groupBy(key).agg(
        F.count(F.lit(1)).cast("bigint").alias("source_total"),
        *[F.count_if(bt == code).cast("bigint").alias(f"source_{col}") for code, col in BEHAVIOR_COLUMNS.items()],
    )


def quality_report(log: DataFrame, features: DataFrame, table: str, checks: list[Check], key: str) -> DataFrame:
    plain, per_key, ranked = {}, {}, {}
    for i, c in enumerate(checks):
        (ranked if c.quantile is not None else per_key if c.per_key else plain)[i] = c

    def row(df: DataFrame, side: str, own: dict[int, Check]) -> DataFrame | None:
        aggs = [e.cast("double").alias(f"{side[0]}{i}") for i, c in own.items() if (e := getattr(c, side)) is not None]
        return df.agg(*aggs) if aggs else None

    rows = [row(features, "feature", plain), row(log_rollup(log, key), "source", plain | per_key)]
    if per_key:
        rows.append(row(_per_key(features, key), "feature", per_key))
    # Each side is one row.
    one = reduce(lambda a, b: a.crossJoin(b), [r for r in rows if r is not None])
    if ranked:
        found = exact_quantiles(features, [c.feature for c in ranked.values()],
                                {f"f{i}": (m, c.quantile) for m, (i, c) in enumerate(ranked.items())})
        one = one.select("*", *as_columns(found))
    src = {i for i, c in enumerate(checks) if c.source is not None}
    # One ``stack`` expression unpivots the single row into one row per check.
    parts = []
    for i, c in enumerate(checks):
        for text in (c.check_id, c.metric, c.rule, c.severity):
            if "'" in text:
                raise ValueError(f"quote in check text: {text!r}")
        s = f"s{i}" if i in src else "CAST(NULL AS DOUBLE)"
        parts.append(f"'{c.check_id}', '{c.metric}', {s}, f{i}, '{c.rule}', '{c.severity}'")
    stacked = one.select(F.expr(
        f"stack({len(checks)}, {', '.join(parts)}) AS (check_id, metric, source_value, feature_value, rule, severity)"))
    s, f, rule = F.col("source_value"), F.col("feature_value"), F.col("rule")
    passed = (F.when(rule == "equal", F.coalesce(s == f, F.lit(False)))
              .when(rule == "zero", F.coalesce(f == 0, F.lit(False)))
              .when(rule == "unit", F.coalesce((f >= 0) & (f <= 1), F.lit(True)))
              .otherwise(F.lit(True)))
    out = stacked.select(
        F.lit(table).alias("table"), "check_id", "metric", "source_value", "feature_value",
        (s - f).alias("diff"), passed.alias("passed"), "severity",
    )
    # Null counts, and the user table's negative values, are listed only for columns that have some.
    listed = (F.col("metric").startswith("null_count:")
              | ((F.col("check_id") == "U10") & F.col("metric").startswith("negative:")))
    return out.where(~(listed & (F.col("feature_value") == 0)))


def _common(key: str, prefix: str, feature_columns: list[str]) -> list[Check]:
    checks = [
        Check(f"{prefix}1", "duplicate_keys",
              F.coalesce(F.sum("key_rows"), F.lit(0)) - F.coalesce(F.sum("key_present"), F.lit(0)), rule="zero", per_key=True),
        Check(f"{prefix}2", "key_count", F.coalesce(F.sum("key_present"), F.lit(0)), F.count(key), per_key=True),
        Check(f"{prefix}3", "total_behavior_cnt", F.sum("total_behavior_cnt"), F.coalesce(F.sum("source_total"), F.lit(0))),
    ]
    checks += [Check(f"{prefix}4", col, F.sum(col), F.coalesce(F.sum(f"source_{col}"), F.lit(0)))
               for col in BEHAVIOR_COLUMNS.values()]
    checks += [Check(f"{prefix}5", f"null_count:{c}", F.count_if(F.col(c).isNull()), rule="info", severity="info")
               for c in feature_columns]
    return checks


def _describe(check_id: str, name: str, column: Column | None = None) -> list[Check]:
    """The eight statistics of a column (mean and std rounded to 6 digits)."""
    c = F.col(name) if column is None else column

    def info(metric: str, value: Column, quantile: float | None = None) -> Check:
        return Check(check_id, f"{metric}:{name}", value, rule="info", severity="info", quantile=quantile)

    def rounded(value: Column) -> Column:
        return F.rint(value * F.lit(1e6)) / F.lit(1e6)

    return [info("count", F.count(c)), info("mean", rounded(F.avg(c))), info("std", rounded(F.stddev_samp(c))),
            info("min", F.min(c)), info("q25", c, 0.25), info("q50", c, 0.5), info("q75", c, 0.75), info("max", F.max(c))]


def _ratio_checks(check_id: str, col: str, severity: str) -> list[Check]:
    c = F.col(col)
    return [
        Check(check_id, f"min:{col}", F.min(c), rule="unit", severity=severity),
        Check(check_id, f"max:{col}", F.max(c), rule="unit", severity=severity),
        Check(check_id, f"out_of_range:{col}", F.count_if((c < 0) | (c > 1)), rule="zero", severity=severity),
    ]


# Ratios that can exceed 1 by definition (no subset relation); the range
# check is reported as information for them.
UNBOUNDED_RATIOS = {"pv_buy_ratio", "cart_buy_ratio", "fav_buy_ratio", "pv_cart_ratio", "buy_user_ratio"}


def user_checks(feature_columns: list[str], numeric_columns: list[str]) -> list[Check]:
    from footfall.schemas import USER_RATE_COLUMNS

    checks = _common("user_id", "U", feature_columns)
    for r in USER_RATE_COLUMNS:
        checks += [Check("U6", f"min:{r}", F.min(r), rule="unit"), Check("U6", f"max:{r}", F.max(r), rule="unit")]
    dev = F.abs(F.col("user_buy_rate") + F.col("user_cart_rate") + F.col("user_fav_rate") + F.col("user_pv_rate")
                - F.lit(1.0))
    checks += _describe("U7", "rate_sum_deviation", dev)
    checks.append(Check("U7", "rate_sum_deviation_gt_0.001", F.count_if(dev > 0.001), rule="zero"))
    checks += _describe("U8", "user_lifetime_days")
    checks.append(Check("U8", "lifetime_lt_1", F.count_if(F.col("user_lifetime_days") < 1), rule="zero"))
    # The number of columns with negative values, and a row for each of them.
    negative = sum((F.when(F.count_if(F.col(c) < 0) > 0, 1).otherwise(0) for c in numeric_columns), F.lit(0))
    checks.append(Check("U10", "negative_columns", negative, rule="zero"))
    checks += [Check("U10", f"negative:{c}", F.count_if(F.col(c) < 0), rule="zero") for c in numeric_columns]
    checks += [Check("U11", f"out_of_range:{r}", F.count_if((F.col(r) < 0) | (F.col(r) > 1)), rule="zero")
               for r in USER_RATE_COLUMNS]
    return checks


def entity_checks(key: str, feature_columns: list[str]) -> list[Check]:
    from footfall.schemas import CATEGORY_NON_NEGATIVE, CATEGORY_RATIO_COLUMNS, ITEM_NON_NEGATIVE, ITEM_RATIO_COLUMNS

    is_item = key == "item_id"
    prefix = "I" if is_item else "C"
    ratios = ITEM_RATIO_COLUMNS if is_item else [c for c in CATEGORY_RATIO_COLUMNS if c != "top_item_ratio"]
    non_negative = ITEM_NON_NEGATIVE if is_item else CATEGORY_NON_NEGATIVE
    life = "item_lifetime_days" if is_item else "category_lifetime_days"
    present = set(feature_columns)
    checks = _common(key, prefix, feature_columns)
    for r in ratios:
        if r in present:
            checks += _ratio_checks(f"{prefix}6", r, "info" if r in UNBOUNDED_RATIOS else "error")
    checks += [Check(f"{prefix}7", f"negative:{c}", F.count_if(F.col(c) < 0), rule="zero")
               for c in non_negative if c in present]
    if life in present:
        checks += _describe(f"{prefix}8", life)
        checks.append(Check(f"{prefix}8", "lifetime_lt_1", F.count_if(F.col(life) < 1), rule="zero"))
    if not is_item and "top_item_ratio" in present:
        checks += _describe("C9", "top_item_ratio")
        checks.append(Check("C9", "out_of_range:top_item_ratio",
                            F.count_if((F.col("top_item_ratio") < 0) | (F.col("top_item_ratio") > 1)), rule="zero"))
    return checks


def reconcile_all(log: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """Every entity, log counts next to table counts, via one full outer
    join on the key (both sides are one row per key).  ``matched`` is False
    for an entity missing on either side or with any differing count."""
    src = log_rollup(log, key)
    tab = features.select(key, F.col("total_behavior_cnt").alias("feature_total"),
                          *[F.col(col).alias(f"feature_{col}") for col in BEHAVIOR_COLUMNS.values()])
    joined = src.join(tab, key, "full_outer")
    pairs = [("source_total", "feature_total")] + [(f"source_{c}", f"feature_{c}") for c in BEHAVIOR_COLUMNS.values()]
    matched = None
    for a, b in pairs:
        eq = F.coalesce(F.col(a) == F.col(b), F.lit(False))
        matched = eq if matched is None else matched & eq
    return joined.withColumn("matched", matched)


def sampled_entity(features: DataFrame, key: str, seed: int = 42, n: int = 1) -> DataFrame:
    """A repeatable pseudo-random choice of ``n`` entities: the smallest
    ``md5("key:seed")`` values (a top-n, no full sort)."""
    text = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    return (features.select(key, F.md5(text).alias("_h"))
            .orderBy("_h", key).limit(n).select(key))


def sampled_entity_check(log: DataFrame, features: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Log counts against table counts for one sampled entity (the reference's
    spot check), with the same columns as :func:`reconcile_all`."""
    chosen = sampled_entity(features, key, seed)
    return reconcile_all(log.join(F.broadcast(chosen), key, "left_semi"),
                         features.join(F.broadcast(chosen), key, "left_semi"), key)
