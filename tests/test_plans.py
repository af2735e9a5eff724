"""Physical-plan properties: no Python UDF, no cartesian product except
broadcast one-row joins, bounded single-partition windows only."""

import re

import pytest

from footfall.plans.entity_features import EntityFeatures
from footfall.plans.registry import events_log
from footfall.plans.user_features import UserFeatures
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def uf(spark):
    return UserFeatures(events_log(spark, SF_SMALL), checkpoint=False)


def test_no_python_udf(spark, uf):
    for df in (uf.table(), EntityFeatures(events_log(spark, SF_SMALL), "item_id").table()):
        plan = _plan(df)
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
            assert node not in plan


def test_no_cartesian_product(uf):
    plan = _plan(uf.table())
    assert "CartesianProduct" not in plan
    # Cross joins only against broadcast single-row frames (thresholds, end date).
    for line in plan.splitlines():
        if "BroadcastNestedLoopJoin" in line:
            assert "BuildRight" in line


def test_raw_event_windows_are_bounded(uf):
    """The only window over raw events is partitioned by (user, hour, part):
    hours of more than PART_ROWS events are dealt to many parts."""
    plan = _plan(uf.user_hour)
    windows = [l for l in plan.splitlines() if "Window [" in l and "row_number" in l]
    assert windows and all("user_id" in w and "timestamp" in w and "part" in w for w in windows)


def test_rollups_preaggregate_before_shuffle(uf):
    """The (user, item, category, hour) rollup has a partial aggregate below
    its exchange (map-side combine)."""
    plan = _plan(uf.uict)
    assert re.search(r"HashAggregate\(keys=\[.*\], functions=\[partial_count", plan)


def test_log_scan_prunes_columns(spark):
    """Only the columns the log needs reach the Parquet scans."""
    from footfall.sources.adapters import lineitem_log

    plan = _plan(lineitem_log(spark, SF_SMALL).select("user_id", "item_id"))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas, plan
    joined = " ".join(schemas)
    for unused in ("l_extendedprice", "l_discount", "l_tax", "l_quantity", "o_totalprice", "o_comment"):
        assert unused not in joined


def test_rollup_exchange_counts_are_bounded(uf):
    """(user, hour) rollup: one exchange of raw events plus two of rollup
    rows; (user, item, category, hour) rollup: one exchange."""
    def exchanges(df):
        return len(re.findall(r"Exchange (hashpartitioning|SinglePartition|RoundRobin|rangepartitioning)",
                              _plan(df)))

    raw_scan_free = uf.log.select("row_id")
    base = exchanges(raw_scan_free)
    assert exchanges(uf.user_hour) - base <= 3
    assert exchanges(uf.uict) - base <= 1


def test_blocks_of_the_bucketed_rollup_need_no_exchange(spark):
    """The (user, hour) rollup is written bucketed by user: its own blocks group and
    window without an exchange, and the base table has fewer than without buckets."""
    def exchanges(df):
        return len(re.findall(r"Exchange hashpartitioning", _plan(df)))

    log = events_log(spark, SF_SMALL)
    bucketed, plain = UserFeatures(log), UserFeatures(log)
    plain.__dict__["user_hour"] = spark.read.parquet(bucketed.user_hour.inputFiles()[0].rsplit("/", 1)[0])
    plain.__dict__["uict"] = bucketed.uict
    assert exchanges(bucketed.hour_block) == 0 and exchanges(bucketed.user_day) == 0
    assert exchanges(bucketed.base) <= exchanges(plain.base) - 4
    same = ["user_id", "active_days", "max_consecutive_active_days", "category_shift_cnt"]
    assert sorted(map(tuple, bucketed.base.select(same).collect())) == sorted(map(tuple, plain.base.select(same).collect()))


def test_bucketed_stages_leave_the_catalog(spark):
    from footfall.session import reliable_checkpoint, temporary_stages

    before = {t.name for t in spark.catalog.listTables()}
    with temporary_stages(spark):
        staged = reliable_checkpoint(spark.range(20), by="id")
        assert staged.count() == 20 and {t.name for t in spark.catalog.listTables()} != before
    assert {t.name for t in spark.catalog.listTables()} == before
