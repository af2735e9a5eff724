"""Sinks: clean log, feature tables, published catalog tables.

All writes overwrite their target and are idempotent, so a stage retried after
a lost executor produces the same files.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import ensure_checkpoint_dir

_NAME = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _identifier(name: str) -> str:
    if not _NAME.match(name):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


def write_log(df: DataFrame, path: str, fmt: str = "parquet", partition_by_date: bool = False) -> None:
    """Write the clean log.  Parquet by default; CSV with a header as an option.

    ``partition_by_date`` lays the files out by event date: a filter on ``date``
    (``read_log(..., with_date=True)``) prunes folders.  Rows are dealt to tasks by
    ranges of (date, user), so a date gets about as many files as it has tasks'
    worth of data, and a large date is split.
    """
    writer = df
    if partition_by_date:
        writer = df.withColumn("date", F.to_date("timestamp")).repartitionByRange("date", "user_id", "row_id")
    w = writer.write.mode("overwrite")
    if partition_by_date:
        w = w.partitionBy("date")
    if fmt == "csv":
        w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_features(df: DataFrame, path: str) -> None:
    """Write a feature table as Parquet."""
    df.write.mode("overwrite").parquet(path)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> DataFrame:
    """Create the target database when missing (optionally at ``location``);
    returns the catalog row."""
    db = _identifier(name)
    where = f" LOCATION '{location}'" if location else ""
    if location and "'" in location:
        raise ValueError("location must not contain quotes")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{where}")
    return spark.sql(f"SHOW DATABASES LIKE '{db}'")


def _versions(spark: SparkSession, base: str):
    """(file system, folders of published versions below ``base``, oldest first)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(root)] if fs.exists(root) else []
    return fs, sorted((p for p in found if p.getName().startswith("version-")), key=lambda p: p.getName())


def publish_table(df: DataFrame, name: str, database: str | None = None,
                  jdbc_options: dict[str, str] | None = None, path: str | None = None) -> str:
    """Replace a named table with ``df``; returns the qualified table name.

    Without ``jdbc_options`` the table goes to the session catalog.  Its rows are written
    aside, to a new version folder below ``path`` (by default below the database's
    location), and only a committed write is swapped in by one change of the table's
    location: a reader sees the old table or the new one, and a failed write
    leaves the old one.  The version before the current one is kept for
    readers that still have its files open; older ones are deleted.  Where the columns
    differ from the old table's, the entry itself is dropped and made anew.

    With ``jdbc_options`` (``url``, ``dbtable``, ``user``, ``password``, ...) the table is
    written to an external database through Spark's JDBC source.
    """
    if jdbc_options:
        df.write.format("jdbc").options(**jdbc_options).mode("overwrite").save()
        return jdbc_options.get("dbtable", name)
    spark = df.sparkSession
    qualified = f"{_identifier(database)}.{_identifier(name)}" if database else _identifier(name)
    if path is None:
        where = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
        path = f"{where.rstrip('/')}/{name}.versions"
    if "'" in path:
        raise ValueError("path must not contain quotes")
    target = f"{path.rstrip('/')}/version-{time.time_ns():020d}"
    try:
        df.write.parquet(target)
        written = spark.read.parquet(target).schema
        if spark.catalog.tableExists(qualified) and spark.table(qualified).schema == written:
            spark.sql(f"ALTER TABLE {qualified} SET LOCATION '{target}'")
        else:
            spark.sql(f"DROP TABLE IF EXISTS {qualified}")
            spark.catalog.createTable(qualified, path=target, source="parquet", schema=written)
    except BaseException:
        fs, versions = _versions(spark, path)
        for version in versions:
            if target.endswith(version.getName()):
                fs.delete(version, True)
        raise
    spark.catalog.refreshTable(qualified)
    fs, versions = _versions(spark, path)
    for version in versions[:-2]:
        fs.delete(version, True)
    return qualified


def published(spark: SparkSession, name: str, jdbc_options: dict[str, str] | None = None) -> DataFrame:
    """The published table, from the catalog or through JDBC."""
    return spark.read.format("jdbc").options(**jdbc_options).load() if jdbc_options else spark.table(name)


def verify_published(table: DataFrame, expected: int | None = None) -> DataFrame:
    """``SELECT COUNT(*) AS total_rows`` on the published table; with ``expected`` (the rows
    that the publishing write observed) also that count and whether they are equal."""
    found = table.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"))
    if expected is None:
        return found
    return found.select("total_rows", F.lit(expected).cast("bigint").alias("expected_rows"),
                        (F.col("total_rows") == expected).alias("matched"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint directory of the session."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/footfall-{label}-{uuid.uuid4().hex}"
