"""End-to-end jobs R1-R7 through storage: raw CSV -> clean log -> feature
tables -> quality report."""

from footfall.plans import jobs
from footfall.plans.registry import events_log
from footfall.plans.user_features import UserFeatures
from footfall.sources import scratch_path
from footfall.sources.adapters import events_raw
from tests.conftest import SF_SMALL


def test_jobs_end_to_end(spark):
    raw_dir, log_dir, out_dir = (scratch_path(spark, x) for x in ("raw", "log", "out"))
    events_raw(spark, SF_SMALL).write.option("header", True).csv(raw_dir)
    res = jobs.clean_job(spark, raw_dir, log_dir, row_id_column="row_id")
    rep = res.report.first()
    assert rep.rows_kept == events_log(spark, SF_SMALL).count()
    overview = jobs.overview_job(spark, log_dir).first()
    assert overview.total_rows == rep.rows_kept
    outs = jobs.feature_jobs(spark, log_dir, out_dir)
    written = spark.read.parquet(outs.user_path)
    direct = UserFeatures(events_log(spark, SF_SMALL)).table()
    assert written.columns == direct.columns
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, direct.collect()))
    rows = jobs.quality_job(spark, log_dir, outs).collect()
    assert {r.table for r in rows} == {"user", "item", "category"}
    assert all(r.passed for r in rows if r.severity == "error"), [r for r in rows if not r.passed]
    assert {r.check_id for r in rows} >= {"U1", "U2", "U3", "U4", "U6", "U7", "U8", "U10", "U11",
                                         "I1", "I2", "I3", "I4", "I6", "I7", "I8",
                                         "C1", "C2", "C3", "C4", "C6", "C7", "C8", "C9"}
