"""Exact quantiles by interval refinement.

The order statistics that the quantiles need are narrowed down together: a pass
counts the rows of every interval in ``BUCKETS`` equal sub-intervals, and the
sub-interval that holds the wanted rank, cut to its smallest and largest value, is the
next interval.  An interval with one value is found, so ties of any size end at
once, and a dense cluster of values only takes another pass.  No task sorts or
holds the values of a metric; a pass sends at most ``BUCKETS`` counts for each open
rank to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.session import reliable_checkpoint

BUCKETS = 256


def _sub_interval(j: int, i: int, lo: float, hi: float) -> str:
    """A row's place in interval ``j`` of metric ``i``, as SQL; halves keep the width finite."""
    v, lo_sql, hi_sql = f"v{i}", f"({lo!r}D)", f"({hi!r}D)"
    share = f"({v} / 2 - {lo_sql} / 2) / ({hi_sql} / 2 - {lo_sql} / 2)"
    return (f"IF({v} BETWEEN {lo_sql} AND {hi_sql}, named_struct('j', {j}, 'b', "
            f"CAST(least({BUCKETS - 1}, floor({share} * {BUCKETS})) AS INT), 'v', {v}), NULL)")


def order_statistics(values: DataFrame, wanted: dict[int, dict[int, float]],
                     bounds: dict[int, tuple[float, float]]) -> dict[tuple[int, int], float]:
    """(metric, rank) -> value for the 0-based ranks ``wanted`` of the columns ``v<metric>``,
    given each metric's smallest and largest value."""
    found: dict[tuple[int, int], float] = {}
    pending = [(i, *bounds[i], 0, sorted(ranks)) for i, ranks in wanted.items() if ranks]
    while pending:
        for i, lo, _, _, ranks in (p for p in pending if p[1] == p[2]):
            found |= {(i, k): lo for k in ranks}
        pending = [p for p in pending if p[1] < p[2]]
        if not pending:
            break
        places = ", ".join(_sub_interval(j, i, lo, hi) for j, (i, lo, hi, _, _) in enumerate(pending))
        counted = (values.select(F.expr(f"inline(array_compact(array({places})))")).groupBy("j", "b")
                   .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
        narrower = []
        for j, (i, _, _, below, ranks) in enumerate(pending):
            for _, _, n, lo, hi in sorted(r for r in counted if r.j == j):
                inside = [k for k in ranks if below <= k < below + n]
                if inside:
                    narrower.append((i, lo, hi, below, inside))
                below += n
        pending = narrower
    return found


def exact_quantiles(df: DataFrame, metrics: list[Column], spec: dict[str, tuple[int, float]]) -> dict[str, float | None]:
    """``name -> value`` for ``spec`` (name -> (metric index, p)): exact quantiles of the
    non-null values, with linear interpolation between the order statistics at ``floor`` and
    ``ceil`` of ``(n - 1) * p``; None for a metric without values.

    ``df`` is read once, into a stage of the metrics alone that the passes share."""
    values = reliable_checkpoint(df.select(*[m.cast("double").alias(f"v{i}") for i, m in enumerate(metrics)]))
    ends = values.agg(*[f(f"v{i}").alias(f"{name}{i}") for i in range(len(metrics))
                        for name, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    wanted: dict[int, dict[int, float]] = {}
    for i, p in spec.values():
        if ends[f"n{i}"]:
            at = (ends[f"n{i}"] - 1) * p
            wanted.setdefault(i, {}).update({math.floor(at): at, math.ceil(at): at})
    found = order_statistics(values, wanted, {i: (ends[f"lo{i}"], ends[f"hi{i}"]) for i in wanted})
    out: dict[str, float | None] = {}
    for name, (i, p) in spec.items():
        if not ends[f"n{i}"]:
            out[name] = None
            continue
        at = (ends[f"n{i}"] - 1) * p
        low, high = math.floor(at), math.ceil(at)
        out[name] = found[i, low] if low == high else (high - at) * found[i, low] + (at - low) * found[i, high]
    return out


def as_columns(values: dict[str, float | None]) -> list[Column]:
    """The quantiles as named DOUBLE literals."""
    return [F.lit(v).cast("double").alias(name) for name, v in values.items()]
