"""footfall — behaviour-log analytics on Spark DataFrames.

Cleans a raw e-commerce behaviour log (view / favourite / cart / buy events),
profiles it, builds wide per-user, per-item and per-category feature tables and
reconciles them with the log.  Everything is expressed with DataFrame
operators and built-in functions; there are no Python UDFs in any plan.

Layout
------
``sources``    readers, sinks and adapters from the test tables to the raw log
``functions``  column-expression helpers (guarded ratios, rounding, coercion)
``operators``  reusable relational building blocks (cleaning, profiling,
               rollups, top-k, sequences, ranking, thresholds, quality)
``plans``      end-to-end jobs composed from operators (feature tables,
               overview, quality reports) and the query registry
``streaming``  the cleaning job run incrementally over arriving files
"""

from footfall.session import get_spark

__all__ = ["get_spark"]
