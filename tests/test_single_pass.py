"""Jobs read their raw input once, and publishing never shows a half table."""

import re

import pytest
from pyspark.sql import functions as F

from footfall.operators.cleaning import clean_log, cleaning_report
from footfall.plans import jobs
from footfall.plans.registry import events_log
from footfall.session import temporary_stages
from footfall.sources import readers, scratch_path, sinks
from footfall.sources.adapters import events_raw
from footfall.streaming import start_clean_stream
from tests.conftest import SF_SMALL

HEADER = "user_id,item_id,behavior_type,item_category,time\n"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_each_coercion_is_evaluated_once(spark):
    plan = _plan(clean_log(events_raw(spark, SF_SMALL)))
    assert plan.count("RLIKE") == 2 and plan.count("date_format") == 1  # one for codes, one for times


def test_raw_csv_is_scanned_once_for_ids_and_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "1,7,1,1,2024-01-01 05\n")
    plan = _plan(readers.read_raw(spark, str(tmp_path)))
    assert plan.count("FileScan csv") == 1 and plan.count("FileScan binaryFile") == 1
    assert "content" not in re.search(r"FileScan binaryFile.*?\n", plan).group()


def test_row_ids_follow_files_splits_and_lines(spark, tmp_path):
    """Files of any size, many splits of a file, several splits in a task, odd names."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    want = []
    folder = tmp_path / "raw dir"
    for part, n in (("part=0", 400), ("part=1", 3), ("part=2", 0), ("part=3", 900)):
        (folder / part).mkdir(parents=True)
        for f in ("a b.csv", "c%20d.csv"):
            items = [f"{len(want) + i}" for i in range(n)]
            (folder / part / f).write_text(HEADER + "".join(f"1,{i},1,1,2024-01-01 05\n" for i in items))
            want += items
    try:
        for most, cost in (("1k", "100"), ("3k", "1"), ("10k", "20k"), ("128m", "4m")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            rows = readers.read_raw(spark, str(folder)).select("row_id", "item_id").collect()
            assert [r.item_id for r in sorted(rows)] == want and len({r.row_id for r in rows}) == len(want)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_observed_report_equals_its_own_pass(spark):
    raw_dir, log_dir = scratch_path(spark, "raw"), scratch_path(spark, "log")
    raw = events_raw(spark, SF_SMALL)
    raw.write.option("header", True).csv(raw_dir)
    with temporary_stages(spark):
        done = jobs.clean_job(spark, raw_dir, log_dir, row_id_column="row_id", spread=5)
        assert done.report.first() == cleaning_report(raw).first()
    assert readers.read_log(spark, log_dir).count() == done.report.first().rows_kept
    rows = jobs.publish_job(spark, raw_dir, "observed", "default", row_id_column="row_id",
                            path=scratch_path(spark, "observed")).first()
    assert rows.matched and rows.total_rows == done.report.first().rows_kept == rows.expected_rows


def test_text_ids_are_published_and_streamed(spark):
    raw_dir, sink = scratch_path(spark, "raw"), scratch_path(spark, "sink")
    raw = events_raw(spark, SF_SMALL).withColumn("user_id", F.concat(F.lit("u"), "user_id"))
    raw.write.option("header", True).csv(raw_dir)
    row = jobs.publish_job(spark, raw_dir, "text_ids", "default", row_id_column="row_id", id_kind="string",
                           path=scratch_path(spark, "text")).first()
    assert row.matched and spark.table("text_ids").where("user_id LIKE 'u%'").count() == row.total_rows
    start_clean_stream(spark, raw_dir, sink, id_kind="string").awaitTermination()
    streamed = readers.read_log(spark, sink, id_kind="string")
    assert streamed.where("user_id LIKE 'u%'").count() == row.total_rows == events_log(spark, SF_SMALL).count()


def test_publishing_swaps_whole_versions(spark):
    path = scratch_path(spark, "versions")

    def publish(df):
        return sinks.publish_table(df, "swapped", path=path)

    publish(spark.range(5))
    reader = spark.table("swapped")
    publish(spark.range(7))
    assert spark.table("swapped").count() == 7 and reader.count() in (5, 7)
    with pytest.raises(Exception):
        publish(spark.range(9).select(F.when(F.col("id") == 8, F.raise_error("stop").cast("bigint")).otherwise(F.col("id")).alias("id")))
    assert spark.table("swapped").count() == 7
    publish(spark.range(3))
    assert len(sinks._versions(spark, path)[1]) == 2  # the current one and the one before
    publish(spark.range(3).withColumn("more", F.lit("x")))
    assert spark.table("swapped").columns == ["id", "more"]
    spark.sql("DROP TABLE swapped")
