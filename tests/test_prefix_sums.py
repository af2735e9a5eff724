"""Event order by prefix sums over ordered parts."""

import datetime as dt
import random

import pytest

from footfall.operators import sequences as S
from footfall.plans.user_features import UserFeatures
from footfall.schemas import LOG


@pytest.fixture(scope="module")
def rows():
    """One user-hour with a third of all events and random 64-bit ids."""
    rng = random.Random(11)
    out = []
    for k in range(3000):
        hot = k % 3 == 0
        user, hour = (1, 5) if hot else (rng.randint(1, 9), rng.randint(0, 8))
        out.append((rng.randint(-2**63, 2**63 - 1), user, rng.randint(1, 6), rng.choice([1, 1, 1, 2, 3, 4]),
                    rng.randint(1, 4), dt.datetime(2024, 1, 1, hour)))
    return out


def plain(rows):
    """Order, steps to buy, category shifts by sorting."""
    by_user = {}
    for r in sorted(rows, key=lambda r: (r[1], r[5], r[0])):
        by_user.setdefault(r[1], []).append(r)
    order = {(u, r[0]): i for u, own in by_user.items() for i, r in enumerate(own, 1)}
    steps = {u: sum(i for i, r in enumerate(own) if r[3] == 4) for u, own in by_user.items()}
    shifts = {u: sum(a[4] != b[4] for a, b in zip(own, own[1:])) for u, own in by_user.items()}
    return order, steps, shifts


@pytest.mark.parametrize("part_rows,parts", [(S.PART_ROWS, None), (200, 12), (1, 5), (0, None)])
def test_equal_to_sorting(spark, rows, part_rows, parts):
    log = spark.createDataFrame(rows, LOG).repartition(4)
    parted = S.in_parts(log, part_rows=part_rows, parts=parts)
    order, steps, shifts = plain(rows)
    assert {(r.user_id, r.row_id): r.behavior_order for r in S.event_order(parted).collect()} == order
    hours = S.across_hours(S.user_hour_rollup(parted))
    for r in hours.groupBy("user_id").agg(*S.sequence_aggregates(hours)).collect():
        assert (r.steps_sum, r.category_shift_cnt) == (steps[r.user_id], shifts[r.user_id])


def test_a_crowded_hour_is_dealt_over_many_tasks(spark, rows):
    log = spark.createDataFrame(rows, LOG)
    parted = S.in_parts(log, part_rows=200, parts=16)
    hot = parted.where("user_id = 1 AND hour(timestamp) = 5").groupBy("part").count().collect()
    n = sum(r["count"] for r in hot)
    assert len(hot) >= 8 and max(r["count"] for r in hot) <= n / 4
    others = parted.where("NOT (user_id = 1 AND hour(timestamp) = 5)").select("part").distinct().collect()
    assert [r.part for r in others] == [0]
    plan = S.within_part(parted)._jdf.queryExecution().executedPlan().toString()
    assert all("part#" in line for line in plan.splitlines() if "Window [" in line)


def test_sizes_come_from_the_rollup(spark, rows):
    """Without a crowded hour the log is read by the rollup and by the window, not more."""
    log = spark.createDataFrame(rows, LOG)
    wide, narrow = UserFeatures(log), UserFeatures(log, part_rows=50)
    same = ["user_id", "avg_steps_to_buy", "category_shift_cnt", "view_before_first_buy_cnt"]
    assert sorted(map(tuple, wide.table().select(same).collect())) == sorted(map(tuple, narrow.table().select(same).collect()))
    joined = ["Join" in f.parted_events._jdf.queryExecution().executedPlan().toString() for f in (wide, narrow)]
    assert joined == [False, True]
