"""Global quantile thresholds, computed once and attached to every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.operators.selection import as_columns, exact_quantiles


def thresholds(df: DataFrame, spec: dict[str, tuple[Column, float]], exact: bool = True,
               accuracy: int = 1_000_000) -> DataFrame:
    """One row with one column per ``name -> (expression, p)``.

    ``exact=True``: exact quantiles by interval refinement; expressions with the same text
    are one metric.  ``exact=False``: ``percentile_approx`` (rank error at most
    n / accuracy), one aggregate.
    """
    if not exact:
        return df.agg(*[F.percentile_approx(e.cast("double"), F.lit(p), F.lit(accuracy)).cast("double").alias(n)
                        for n, (e, p) in spec.items()])
    metrics: dict[str, Column] = {str(e): e for e, _ in spec.values()}
    place = {text: i for i, text in enumerate(metrics)}
    found = exact_quantiles(df, list(metrics.values()), {n: (place[str(e)], p) for n, (e, p) in spec.items()})
    return df.sparkSession.range(1).select(*as_columns(found))


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Cross join with a single-row frame; broadcasting one row is always
    safe."""
    return df.crossJoin(F.broadcast(one_row))
