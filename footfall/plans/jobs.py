"""End-to-end jobs (R1-R7): what the reference's scripts do, as Spark jobs.

Each job reads its input from storage, writes its output to storage and
returns small report DataFrames (cleaning report, overview, quality rows).
All writes overwrite their target, so a job retried after a failure produces
the same files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from footfall.operators import profiling as P
from footfall.operators import quality as Q
from footfall.operators.cleaning import clean_log, coerced, kept_rows, report_counts
from footfall.plans.entity_features import EntityFeatures
from footfall.plans.user_features import UserFeatures
from footfall.schemas import RAW_COLUMNS
from footfall.session import reliable_checkpoint, temporary_stages
from footfall.sources import readers, sinks


@dataclass
class CleanResult:
    report: DataFrame          # rows in / kept / removed and per reason
    log_path: str
    profile: dict[str, DataFrame]  # column info, null counts, duplicates, codes of the raw log


def clean_job(spark: SparkSession, raw_path: str, log_path: str, fmt: str = "parquet",
              row_id_column: str | None = None, partition_by_date: bool = True,
              id_kind: str = "bigint", spread: int | None = None) -> CleanResult:
    """R1: raw CSV -> clean log (Parquet by default, partitioned by date), with
    the report of the cleaning and the profile of the raw log (lazy frames).

    The CSV is read and coerced once, into a stage; the report is observed by
    that write.  The log's date ranges, which need a sample, and the profile read the stage,
    which goes at the end of the caller's :func:`footfall.session.temporary_stages`.
    ``spread`` deals the rows of files that can't be split to that many tasks."""
    raw = readers.read_raw(spark, raw_path, row_id_column=row_id_column, spread=spread)
    report = Observation("cleaning report")
    staged = reliable_checkpoint(coerced(raw).observe(report, *report_counts()))
    sinks.write_log(kept_rows(staged, id_kind), log_path, fmt=fmt, partition_by_date=partition_by_date)
    text = staged.select(*RAW_COLUMNS)
    profile = {"column_info": P.column_info(text), "null_counts": P.null_counts(text),
               "duplicate_rows": P.duplicate_rows(text), "behavior_distribution": P.value_counts(text, "behavior_type")}
    return CleanResult(_one_row(spark, report), log_path, profile)


def _one_row(spark: SparkSession, seen: Observation) -> DataFrame:
    counts = seen.get
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} bigint" for c in counts))


def publish_job(spark: SparkSession, raw_path: str, table: str = "user_behavior", database: str = "footfall",
                jdbc_options: dict[str, str] | None = None, row_id_column: str | None = None,
                id_kind: str = "bigint", spread: int | None = None, path: str | None = None) -> DataFrame:
    """R2: clean, create the database, replace the table, compare its row count with
    the rows that the cleaning kept, as observed by the write (one pass over the CSV)."""
    report = Observation("cleaning report")
    log = clean_log(readers.read_raw(spark, raw_path, row_id_column=row_id_column, spread=spread), id_kind, report)
    if jdbc_options is None:
        sinks.ensure_database(spark, database)
    name = sinks.publish_table(log, table, database=None if jdbc_options else database,
                               jdbc_options=jdbc_options, path=path)
    return sinks.verify_published(sinks.published(spark, name, jdbc_options), report.get["rows_kept"])


def overview_job(spark: SparkSession, log_path: str, fmt: str = "parquet", id_kind: str = "bigint") -> DataFrame:
    """R3: rows, distinct users / items / categories, time range, events per user."""
    return P.overview(readers.read_log(spark, log_path, fmt=fmt, id_kind=id_kind))


@dataclass
class FeatureOutputs:
    user_path: str
    item_path: str
    category_path: str


def feature_jobs(spark: SparkSession, log_path: str, out_dir: str, fmt: str = "parquet",
                 exact_quantiles: bool = True, id_kind: str = "bigint") -> FeatureOutputs:
    """R4-R6: user, item and category tables written as Parquet."""
    log = readers.read_log(spark, log_path, fmt=fmt, id_kind=id_kind)
    out = FeatureOutputs(f"{out_dir}/user_features", f"{out_dir}/item_features", f"{out_dir}/category_features")
    # The rollups that a table was built from go when its sink has committed.
    with temporary_stages(spark):
        sinks.write_features(UserFeatures(log, exact_quantiles=exact_quantiles).table(), out.user_path)
    with temporary_stages(spark):
        sinks.write_features(EntityFeatures(log, "item_id").table(), out.item_path)
        sinks.write_features(EntityFeatures(log, "item_category").table(), out.category_path)
    return out


def quality_job(spark: SparkSession, log_path: str, features: FeatureOutputs, fmt: str = "parquet",
                id_kind: str = "bigint") -> DataFrame:
    """R7: the quality checks of all three tables against the log, as rows."""
    log = readers.read_log(spark, log_path, fmt=fmt, id_kind=id_kind)
    users = readers.read_features(spark, features.user_path)
    items = readers.read_features(spark, features.item_path)
    cats = readers.read_features(spark, features.category_path)
    return (Q.quality_report(log, users, "user", Q.user_checks(users.columns, P.numeric_columns(users)), "user_id")
            .unionByName(Q.quality_report(log, items, "item", Q.entity_checks("item_id", items.columns), "item_id"))
            .unionByName(Q.quality_report(log, cats, "category", Q.entity_checks("item_category", cats.columns), "item_category")))
