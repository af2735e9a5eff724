"""Top-k and percentile-rank operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Coarse value buckets per octave of |v| + 1 (see ranked_histogram).
BUCKETS_PER_OCTAVE = 1024


def _coarse(v: Column, per_octave: int) -> Column:
    """A monotone (non-decreasing) integer bucket of any real value: each
    octave of ``|v| + 1`` is cut into ``per_octave`` parts, negative values
    map below zero."""
    b = F.lit(float(per_octave))
    return (F.when(v >= 0, F.floor(F.log2(v + F.lit(1.0)) * b))
            .otherwise(-F.floor(F.log2(F.lit(1.0) - v) * b) - F.lit(1))).cast("bigint")


def ranked_histogram(df: DataFrame, metrics: list[Column], per_octave: int = BUCKETS_PER_OCTAVE) -> DataFrame:
    """(``_m``, ``_v``, ``_ties``, ``_less``, ``_total``) per metric index and
    distinct non-null value: how many rows hold the value, how many hold a
    smaller one, and how many non-null rows the metric has.

    The metrics are unpivoted and counted per distinct value (partial
    aggregation).  The running count is split in two levels so that no task
    holds all distinct values of a metric: inside a coarse, monotone value
    bucket (a window per (metric, bucket)), plus the count of all smaller
    buckets (a window per metric over its buckets, at most ``per_octave``
    per octave of the value range).
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("_m"), m.cast("double").alias("_v")) for i, m in enumerate(metrics)])
    hist = (df.select(F.inline(pairs)).where(F.col("_v").isNotNull())
            .groupBy("_m", "_v").agg(F.count(F.lit(1)).cast("bigint").alias("_ties"))
            .withColumn("_c", _coarse(F.col("_v"), per_octave)))
    inner = Window.partitionBy("_m", "_c").orderBy("_v")
    within = hist.select(
        "_m", "_c", "_v", "_ties",
        F.coalesce(F.sum("_ties").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .cast("bigint").alias("_less_in"),
    )
    buckets = hist.groupBy("_m", "_c").agg(F.sum("_ties").cast("bigint").alias("_bucket_n"))
    outer = Window.partitionBy("_m").orderBy("_c")
    offsets = buckets.select(
        "_m", "_c",
        F.coalesce(F.sum("_bucket_n").over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .cast("bigint").alias("_offset"),
        F.sum("_bucket_n").over(Window.partitionBy("_m")).cast("bigint").alias("_total"),
    )
    return within.join(offsets, ["_m", "_c"]).select(
        "_m", "_v", "_ties", (F.col("_offset") + F.col("_less_in")).alias("_less"), "_total")


def pct_ranks(df: DataFrame, columns: dict[str, str], hist: DataFrame | None = None,
              index: dict[str, int] | None = None, bounded: bool = True) -> DataFrame:
    """Average-tie percentile rank ``(rank + (ties - 1) / 2) / n`` of several
    columns over all rows of ``df`` (NULL stays NULL and is not counted).

    Ranks come from one :func:`ranked_histogram` (built here, or passed in with the
    metric index of every column), joined back once per column on the value.  A
    common value (say one active day) can hold a large share of all rows, so the
    rank table of a column, filtered to that column alone, is broadcast.  ``bounded``
    says that the columns have few distinct values: days, or counts of events per
    user (k distinct counts need k * k / 2 events, so a trillion events have at most
    1.4 million).  Without such a bound pass False for a sort-merge join."""
    names = list(columns)
    if hist is None:
        hist = ranked_histogram(df, [F.col(c) for c in names])
        index = {c: i for i, c in enumerate(names)}
    ranks = hist.select(
        "_m", "_v",
        ((F.col("_less").cast("double") + (F.col("_ties").cast("double") + F.lit(1.0)) / F.lit(2.0))
         / F.col("_total").cast("double")).alias("_pct"),
    )
    out = df
    for c in names:
        i = index[c]
        r = ranks.where(F.col("_m") == i).select(F.col("_v").alias(f"_v{i}"), F.col("_pct").alias(columns[c]))
        out = out.join(F.broadcast(r) if bounded else r, F.col(c).cast("double") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
    return out
