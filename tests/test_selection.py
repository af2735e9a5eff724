"""Quantiles by interval refinement against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators import selection
from footfall.operators.selection import exact_quantiles

PS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def _check(spark, columns):
    n = max(map(len, columns))
    rows = [tuple(c[k] if k < len(c) else None for c in columns) for k in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(len(columns))))
    got = exact_quantiles(df.repartition(3), [F.col(f"c{i}") for i in range(len(columns))],
                          {f"{i}:{p}": (i, p) for i in range(len(columns)) for p in PS})
    for i, own in enumerate(columns):
        own = sorted(v for v in own if v is not None)
        for p in PS:
            if not own:
                assert got[f"{i}:{p}"] is None
                continue
            at = (len(own) - 1) * p
            lo, hi = int(np.floor(at)), int(np.ceil(at))
            want = own[lo] if lo == hi else (hi - at) * own[lo] + (at - lo) * own[hi]
            assert got[f"{i}:{p}"] == want


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_equal_to_sorting(spark, monkeypatch, buckets):
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    rng = random.Random(buckets)
    _check(spark, [
        [float(rng.randint(0, 9)) for _ in range(300)],                       # ties
        [rng.gauss(0, 1) for _ in range(201)],
        [1e9 + rng.random() * 1e-3 for _ in range(150)] + [-1e300, 1e300],     # a dense cluster in a wide range
        [5.0] * 40, [None], [-0.0, 0.0, 2.5], [None, 3.0, None]])


def test_no_window_and_bounded_counts(spark):
    """A pass is one partial aggregate; nothing is sorted by value."""
    df = spark.range(10_000).select((F.col("id") % 997).cast("double").alias("v0"))
    counted = selection.order_statistics(df, {0: {4_000: 4_000}}, {0: (0.0, 996.0)})
    assert counted[0, 4_000] == sorted(i % 997 for i in range(10_000))[4_000]
    plan = df.select(F.expr(f"inline(array_compact(array({selection._sub_interval(0, 0, 0.0, 996.0)})))")).groupBy(
        "j", "b").agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort " not in plan and "partial_count" in plan
