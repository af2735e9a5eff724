"""SparkSession helper used by tests, bench and examples.

On a cluster the session is created by the platform or the submit command;
``get_spark`` without a master only fills in settings that are still unset.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on.  ANSI mode stays on (Spark 4 default); the
# code guards every division and cast instead of switching it off.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Local runs only (tests, bench): no delay scheduling for data locality.
_LOCAL_DEFAULTS = {"spark.locality.wait": "0s"}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "footfall") -> SparkSession:
    """Return the active session or build one.

    A setting that the submit command or the cluster has set stays as it is; the
    master is set only when the caller names one (tests and bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        wanted = _DEFAULTS | _LOCAL_DEFAULTS | {
            "spark.master": master, "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
            "spark.driver.memory": os.environ.get("FOOTFALL_DRIVER_MEMORY", "16g")}
    else:
        SparkContext._ensure_initialized()  # the submit command's settings are the JVM's
        submitted = SparkConf()
        wanted = {k: v for k, v in _DEFAULTS.items() if not submitted.contains(k)}
        if shuffle_partitions:
            wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in wanted.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory named by the cluster.

    ``spark.checkpoint.dir`` is read from the session, then the directory that
    the context was given.  With neither, a local master (tests) gets a private
    scratch folder; on a cluster that is an error, because executors would write
    to disks that nobody else can read.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
        master = spark.sparkContext.master
        if not configured and not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = configured or tempfile.mkdtemp(prefix="footfall-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


_stages: list[str] = []
_tables: list[str] = []


@contextmanager
def temporary_stages(spark: SparkSession):
    """Delete the stages that were materialized inside the block at its end,
    when the job's own outputs have been committed."""
    before, tables = len(_stages), len(_tables)
    try:
        yield
    finally:
        for name in _tables[tables:]:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
        del _tables[tables:]
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in _stages[before:]:
            target = hadoop.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        del _stages[before:]


def reliable_checkpoint(df, by: str | None = None):
    """``df`` written once as a Parquet table below the session's shared
    ``spark.checkpoint.dir`` and read back: the lineage is cut (a lost
    executor does not send the job back to the log), the data is computed by
    a single job (an RDD checkpoint would compute the last stage twice), and
    later readers get column pruning and real size statistics for the
    adaptive planner.

    ``by``: the stage is bucketed by that column into as many buckets as a shuffle has
    partitions, so that readers grouping, joining or ranking by it need no exchange.  Only
    for columns of which no value holds many rows: a bucket is one task.  Buckets need an
    entry in the catalog, which goes with the stage."""
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/footfall-stage-{uuid.uuid4().hex}"
    _stages.append(path)
    if by:
        name = f"footfall_stage_{uuid.uuid4().hex}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        _tables.append(name)
        df.write.option("path", path).format("parquet").bucketBy(buckets, by).sortBy(by).saveAsTable(name)
        return spark.table(name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
