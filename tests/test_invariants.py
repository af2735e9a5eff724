"""Invariants from the test strategy: CSV input end to end, metamorphic
duplication of users, and a fault injected into a feature table being found
by the quality report."""

import uuid

from pyspark.sql import functions as F

from footfall.operators import quality as Q
from footfall.operators.cleaning import clean_log, cleaning_report
from footfall.operators.profiling import numeric_columns
from footfall.plans.registry import events_log
from footfall.plans.user_features import UserFeatures
from footfall.session import ensure_checkpoint_dir
from footfall.sources.readers import read_raw
from tests.conftest import SF_SMALL

CSV = """user_id,item_id,behavior_type,item_category,time
1,10,1,100,2024-01-05 10
1,10,4,100,2024-01-05 10
NA,10,1,100,2024-01-05 10
2,,1,100,2024-01-05 11
2,11,x,101,2024-01-05 12
2,11,1.0,101,2024-1-6 3
3,12,2,102,2024-01-05 24
3,12,3,null,2024-01-05 09
"""


def test_csv_file_end_to_end(spark, tmp_path_factory):
    folder = f"{ensure_checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    import os

    os.makedirs(folder)
    with open(f"{folder}/raw.csv", "w") as fh:
        fh.write(CSV)
    raw = read_raw(spark, folder)
    rep = cleaning_report(raw).first()
    assert (rep.rows_in, rep.rows_kept, rep.rows_removed) == (8, 3, 5)
    assert (rep.missing_user_id, rep.missing_item_id, rep.missing_item_category) == (1, 1, 1)
    assert (rep.invalid_behavior, rep.invalid_time) == (1, 1)
    log = clean_log(raw).orderBy("row_id").collect()
    assert [(r.user_id, r.item_id, r.behavior_type) for r in log] == [(1, 10, 1), (1, 10, 4), (2, 11, 1)]


def test_duplicated_users_keep_their_values(spark):
    """Adding a renamed copy of every user leaves every per-user value that
    does not depend on other users unchanged."""
    log = events_log(spark, SF_SMALL)
    offset = 10 ** 9
    copy = log.select((F.col("row_id") + offset).alias("row_id"), (F.col("user_id") + offset).alias("user_id"),
                      "item_id", "behavior_type", "item_category", "timestamp")
    cols = ["user_id", "total_behavior_cnt", "pv_cnt", "buy_cnt", "active_days", "peak_active_hour",
            "category_shift_cnt", "avg_steps_to_buy", "first_buy_interval", "max_consecutive_active_days",
            "dominant_category_stability", "top_item_id", "repeat_view_without_buy", "impulsive_buy_flag"]
    one = UserFeatures(log, checkpoint=False).base.select(*cols)
    both = UserFeatures(log.unionByName(copy), checkpoint=False).base.select(*cols)
    a = sorted(tuple(r) for r in one.collect())
    b = sorted(tuple(r) for r in both.where(F.col("user_id") < offset).collect())
    c = sorted(tuple([r[0] - offset] + list(r[1:])) for r in both.where(F.col("user_id") >= offset).collect())
    assert a == b == c


def test_injected_fault_is_found(spark):
    log = events_log(spark, SF_SMALL)
    users = UserFeatures(log).table()
    victim = users.agg(F.min("user_id")).first()[0]
    broken = users.withColumn("pv_cnt", F.when(F.col("user_id") == victim, F.col("pv_cnt") + 1)
                              .otherwise(F.col("pv_cnt")))
    rows = Q.quality_report(log, broken, "user", Q.user_checks(broken.columns, numeric_columns(broken)), "user_id").collect()
    failed = {r.metric for r in rows if not r.passed}
    assert failed == {"pv_cnt"}
    clean = Q.quality_report(log, users, "user", Q.user_checks(users.columns, numeric_columns(users)), "user_id").collect()
    assert all(r.passed for r in clean)
    recon = Q.reconcile_all(log, broken, "user_id").where(~F.col("matched")).collect()
    assert [r.user_id for r in recon] == [victim]
