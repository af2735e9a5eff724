"""Two-stage duplicate count and bitmap distinct counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import profiling as P
from footfall.operators.quality import log_rollup
from footfall.plans.registry import events_log
from footfall.schemas import LOG, RAW
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(n=2000):
    rng = random.Random(4)
    return [(i, *[rng.choice([None, "a", "b", "", str(rng.randint(0, 40))]) for _ in range(5)]) for i in range(n)]


@pytest.mark.parametrize("few", [P.BROADCAST_DIGESTS, 0])
@pytest.mark.parametrize("digest", [P.row_digest, lambda cols: F.struct((F.xxhash64(*cols) % 7).alias("a")),
                                    lambda cols: F.struct(F.lit(1).alias("a"))])
def test_duplicates_are_exact_under_any_digest(spark, monkeypatch, digest, few):
    monkeypatch.setattr(P, "BROADCAST_DIGESTS", few)
    rows = _rows()
    want = len(rows) - len({r[1:] for r in rows})
    got = P.duplicate_rows(spark.createDataFrame(rows, RAW).repartition(3), digest=digest).first()
    assert (got.duplicate_cnt, got.row_cnt) == (want, len(rows)) and want > 0
    assert got.duplicate_ratio == pytest.approx(want / len(rows))


def test_duplicates_of_no_rows(spark):
    assert P.duplicate_rows(spark.createDataFrame([], RAW)).first().asDict() == {
        "duplicate_cnt": 0, "duplicate_ratio": None, "row_cnt": 0}


def test_digest_shuffle_is_narrow(spark):
    """Sixteen bytes of digest and a count, whatever the row holds."""
    df = spark.createDataFrame(_rows(100), RAW).drop("row_id")
    counted = df.select(P.row_digest(df.columns).alias("d")).groupBy("d").count()
    plan = _plan(counted)
    assert "partial_count" in plan and not any(c in line for c in df.columns for line in plan.splitlines() if "Exchange" in line)


@pytest.mark.parametrize("ids", [list(range(-70, 500)), [-2**63, 2**63 - 1, 0, -1, 63, 64, None, None], [None], []])
def test_bitmap_words_count_dense_and_sparse_ids(spark, ids):
    df = spark.createDataFrame([(i, (i or 0) % 3, i) for i in ids * 2], "x long, y int, z long")
    got = P.cardinalities(df, ["x", "y", "z"]).first()
    assert tuple(got) == (len(set(ids) - {None}), len({(i or 0) % 3 for i in ids}), len(set(ids) - {None}))


def test_text_ids_are_counted_as_values(spark):
    df = spark.createDataFrame([("a", None), ("b", "x"), (None, "x"), ("a", "")], "x string, y string")
    assert tuple(P.cardinalities(df, ["x", "y"]).first()) == (2, 2)


def test_overview_and_report_read_the_log_once(spark):
    log = events_log(spark, SF_SMALL)
    for df in (P.overview(log), log_rollup(log, "user_id"), P.cardinalities(log, ["user_id", "item_id"])):
        assert _plan(df).count("FileScan parquet") == 1
    rows = [(1, 7, 2, 1, 3, dt.datetime(2024, 1, 1, 5)), (2, 7, 3, 1, None, dt.datetime(2024, 1, 2, 5)),
            (3, None, 3, 4, 3, None)]
    got = P.overview(spark.createDataFrame(rows, LOG)).first()
    assert (got.total_rows, got.user_cnt, got.item_cnt, got.category_cnt, got.avg_behavior_per_user) == (3, 1, 2, 1, 3.0)
    assert (got.first_time, got.last_time) == (rows[0][5], rows[1][5])
    empty = P.overview(spark.createDataFrame([], LOG)).first()
    assert empty.total_rows == 0 and empty.first_time is None and empty.avg_behavior_per_user is None
