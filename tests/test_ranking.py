"""Ranked histogram, quantiles and percentile ranks against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from footfall.operators.ranking import pct_ranks, ranked_histogram
from footfall.operators.thresholds import thresholds


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([-3.5, -1.0, 0.0, 0.25, 1.0, 2.0, 2.0, 7.0, 1e6]) * rng.randint(1, 3),
             float(rng.randint(0, 5)) if i % 7 else None) for i in range(400)]
    return rows, spark.createDataFrame(rows, "id long, a double, b double")


@pytest.mark.parametrize("per_octave", [1, 4, 1024])
def test_ranked_histogram_matches_brute_force(values, per_octave):
    rows, df = values
    got = {(r._m, r._v): (r._ties, r._less, r._total)
           for r in ranked_histogram(df, [F.col("a"), F.col("b")], per_octave).collect()}
    for m, col in enumerate((1, 2)):
        vals = [r[col] for r in rows if r[col] is not None]
        for v in set(vals):
            assert got[(m, v)] == (vals.count(v), sum(x < v for x in vals), len(vals))


def test_quantiles_and_ranks_match_pandas(values):
    rows, df = values
    pdf = pd.DataFrame(rows, columns=["id", "a", "b"])
    t = thresholds(df, {"qa": (F.col("a"), 0.75), "qb": (F.col("b"), 0.25), "mb": (F.col("b"), 0.5)}).first()
    assert t.qa == pytest.approx(pdf.a.quantile(0.75), rel=1e-12)
    assert t.qb == pytest.approx(pdf.b.quantile(0.25), rel=1e-12)
    assert t.mb == pytest.approx(pdf.b.median(), rel=1e-12)
    ranked = pct_ranks(df, {"a": "ra", "b": "rb"}).orderBy("id").toPandas()
    assert np.allclose(ranked.ra, pdf.a.rank(pct=True), equal_nan=True)
    assert np.allclose(ranked.rb.astype(float), pdf.b.rank(pct=True), equal_nan=True)
