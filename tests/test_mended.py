"""Cases that once lost rows or gave wrong answers without an error."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from footfall.functions import coerce_behavior, coerce_hour
from footfall.operators import profiling as P
from footfall.operators import sequences as S
from footfall.operators.cleaning import clean_log, require_columns
from footfall.operators.ranking import pct_ranks
from footfall.plans import jobs
from footfall.plans.registry import events_log
from footfall.plans.user_features import UserFeatures
from footfall.schemas import LOG, RAW
from footfall.session import ensure_checkpoint_dir
from footfall.sources import readers, scratch_path, sinks
from footfall.sources.adapters import events_raw
from footfall.streaming import start_clean_stream
from tests.conftest import SF_SMALL

HEADER = "user_id,item_id,behavior_type,item_category,time\n"


@pytest.mark.parametrize("text", ["2d", "1f", "2D", "1L", "0x1", "1e", "nan", ""])
def test_numbers_with_suffixes_are_missing(spark, text):
    assert spark.range(1).select(coerce_behavior(F.lit(text)).alias("b")).first().b is None


@pytest.mark.parametrize("text,kept", [("1500-01-01 05", False), ("3000-01-01 05", False), ("1677-09-21 00", False),
                                       ("1677-09-21 01", True), ("2262-04-11 23", True), ("2262-04-12 00", False)])
def test_years_outside_the_nanosecond_range_are_missing(spark, text, kept):
    got = spark.range(1).select(coerce_hour(F.lit(text)).alias("t")).first().t
    assert (got == dt.datetime.strptime(text, "%Y-%m-%d %H")) if kept else got is None


def test_raw_csv_ids_follow_the_files_not_their_sizes(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text(HEADER + "1,7,1,1,2024-01-01 05\n")
    (tmp_path / "part-1.csv").write_text(HEADER + "".join(f"1,{i},1,1,2024-01-01 05\n" for i in range(100, 3000)))
    rows = readers.read_raw(spark, str(tmp_path)).orderBy("row_id").collect()
    assert [r.item_id for r in rows] == ["7", *map(str, range(100, 3000))]
    assert len({r.row_id for r in rows}) == len(rows)


def test_csv_log_with_bad_text_fails(spark, tmp_path):
    (tmp_path / "log.csv").write_text(",".join(LOG.fieldNames()) + "\n1,abc,2,1,3,2024-01-01 05:00:00\n")
    with pytest.raises(Exception):
        readers.read_log(spark, str(tmp_path), fmt="csv").collect()


def _landing(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_text("row_id," + HEADER + "1,1,7,1,1,2024-01-01 05\n2,1,8,1,1,2024-01-01 06\n")
    return str(landing)


def test_two_streams_of_one_source_have_their_own_state(spark, tmp_path):
    landing = _landing(spark, tmp_path)
    for name in ("one", "two"):
        start_clean_stream(spark, landing, str(tmp_path / name)).awaitTermination()
        assert readers.read_log(spark, str(tmp_path / name)).count() == 2
    with pytest.raises(ValueError, match="no state"):
        start_clean_stream(spark, landing, str(tmp_path / "one"), checkpoint_location=str(tmp_path / "new-state"))


def test_events_without_an_id_fail(spark, tmp_path):
    with pytest.raises(ValueError):
        start_clean_stream(spark, str(tmp_path), str(tmp_path / "sink"), row_id_column=None)
    log = spark.createDataFrame([(None, 1, 2, 1, 3, dt.datetime(2024, 1, 1)), (1, 1, 2, 1, 3, dt.datetime(2024, 1, 1))], LOG)
    with pytest.raises(Exception, match="without row_id"):
        S.user_hour_rollup(S.in_parts(log, part_rows=0)).collect()


def test_sparse_and_negative_ids(spark):
    ids = [-2**63, -2**40, -1, 0, 1, 2**16, 2**40, 2**63 - 1]
    log = spark.createDataFrame([(i, 1, k, 1, 3, dt.datetime(2024, 1, 1)) for k, i in enumerate(ids)], LOG)
    got = {r.row_id: r.behavior_order for r in S.event_order(S.in_parts(log)).collect()}
    assert got == {i: k + 1 for k, i in enumerate(ids)}


def test_checkpoint_folder_is_required_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": lambda self, *_: None})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_submitted_settings_stay(tmp_path):
    code = ("from footfall.session import get_spark; s = get_spark(); "
            "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.sql.session.timeZone'))")
    submit = ("--master local[2] --conf spark.sql.shuffle.partitions=123 --conf spark.sql.session.timeZone=Asia/Tokyo "
              "--conf spark.ui.enabled=false pyspark-shell")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"PYSPARK_SUBMIT_ARGS": submit, "PYTHONPATH": root},
                         capture_output=True, text=True, cwd=tmp_path, timeout=120)
    assert "GOT local[2] 123 Asia/Tokyo" in out.stdout, out.stderr[-800:]


def test_rank_tables_are_broadcast_without_the_wide_metrics(spark):
    df = spark.range(50).selectExpr("id", "id % 3 AS days", "rand(1) AS ratio")
    plan = pct_ranks(df, {"days": "r"})._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    got = pct_ranks(df, {"days": "r"}).select("days", "r").distinct().orderBy("days").collect()
    ties = [17, 17, 16]
    assert [r.r for r in got] == [pytest.approx((sum(ties[:k]) + (ties[k] + 1) / 2) / 50) for k in range(3)]


def test_date_layout_is_bounded_and_prunes(spark):
    path = scratch_path(spark, "dated")
    log = events_log(spark, SF_SMALL).repartition(16)
    sinks.write_log(log, path, partition_by_date=True)
    files = spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().count()
    dates = log.select(F.to_date("timestamp")).distinct().count()
    assert files <= dates + spark.sparkContext.defaultParallelism * 2
    recent = readers.read_log(spark, path, with_date=True).where("date >= DATE'2024-01-10'")
    assert "PartitionFilters: [isnotnull(date" in recent._jdf.queryExecution().executedPlan().toString()


def test_jobs_leave_no_stage_and_profile_the_raw_log(spark):
    raw_dir, log_dir, out_dir = (scratch_path(spark, x) for x in ("raw", "log", "out"))
    raw = events_raw(spark, SF_SMALL)
    raw.write.option("header", True).csv(raw_dir)
    cleaned = jobs.clean_job(spark, raw_dir, log_dir, row_id_column="row_id")
    assert cleaned.profile["duplicate_rows"].first().row_cnt == raw.count()
    assert {r["column"] for r in cleaned.profile["null_counts"].collect()} == set(RAW.fieldNames()) - {"row_id"}
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = {n for n in os.listdir(folder) if n.startswith("footfall-stage-")}
    jobs.feature_jobs(spark, log_dir, out_dir)
    assert {n for n in os.listdir(folder) if n.startswith("footfall-stage-")} == before


def test_count_only_families_have_no_event_window(spark):
    log = events_log(spark, SF_SMALL)
    counts = UserFeatures(log, checkpoint=False, sequences=False)
    plan = counts.user_hour._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan


def test_small_helpers(spark):
    with pytest.raises(ValueError, match="missing columns"):
        require_columns(spark.range(1), ["id", "x"])
    with pytest.raises(ValueError, match="missing columns"):
        clean_log(spark.range(1))
    df = spark.createDataFrame([(1, 1.5, "a", None), (2, None, "b", None)], "i int, d double, s string, n string")
    assert P.numeric_columns(df) == ["i", "d"] and P.numeric_columns(df, floating_only=True) == ["d"]
    assert {r["column"] for r in P.null_counts(df, positive_only=True).collect()} == {"d", "n"}


def test_text_ids_through_the_jobs(spark):
    raw_dir, log_dir, out_dir = (scratch_path(spark, x) for x in ("raw", "log", "out"))
    raw = events_raw(spark, SF_SMALL).withColumn("user_id", F.concat(F.lit("u"), "user_id"))
    raw.write.option("header", True).csv(raw_dir)
    jobs.clean_job(spark, raw_dir, log_dir, row_id_column="row_id", id_kind="string")
    assert readers.read_log(spark, log_dir, id_kind="string").where("user_id not like 'u%'").count() == 0
    users = spark.read.parquet(jobs.feature_jobs(spark, log_dir, out_dir, id_kind="string").user_path)
    plain = UserFeatures(events_log(spark, SF_SMALL)).table()
    same = ["total_behavior_cnt", "active_days", "avg_steps_to_buy", "retention_score"]
    got = {r.user_id[1:]: [r[c] for c in same] for r in users.collect()}
    assert got == {str(r.user_id): [r[c] for c in same] for r in plain.collect()}


def test_published_count_is_compared(spark):
    rows = spark.range(5)
    table = sinks.published(spark, sinks.publish_table(rows, "counted", path=scratch_path(spark, "table")))
    assert sinks.verify_published(table, 5).first().asDict() == {"total_rows": 5, "expected_rows": 5, "matched": True}
    assert not sinks.verify_published(table, 4).first().matched
