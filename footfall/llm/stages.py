"""Written intermediate tables for the operators of this subpackage."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only when it is unset and the master is local (tests) a private folder is
    created and set; on a cluster an unset folder is an error, because
    executors would write to disks that nobody else can read.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local[") and master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    configured = tempfile.mkdtemp(prefix="footfall-llm-")
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured


class _Written(threading.local):
    """Paths of the tables that this thread has staged and not deleted."""

    def __init__(self):
        self.paths: list[str] = []


_written = _Written()


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back: its
    lineage is cut, so a lost executor repeats one step and not the job."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _written.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_count() -> int:
    """Number of tables staged so far, for :func:`restage`."""
    return len(_written.paths)


def restage(df: DataFrame, name: str, since: int) -> DataFrame:
    """``df`` staged, and when it has been committed, the tables that this thread staged
    after the first ``since`` ones deleted: nothing but ``df`` may still need them."""
    out, spark = stage(df, name), df.sparkSession
    old = _written.paths[since:-1]
    del _written.paths[since:-1]
    for path in old:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return out


def with_field(df: DataFrame, name: str, kind: str) -> StructType:
    """Schema of ``df`` with one more column."""
    return StructType([*df.schema.fields, StructField(name, _parse_datatype_string(kind))])


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column has the name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


class Shared:
    """A read-only object for all tasks, of bounded size, that travels with its
    class and is unpacked once in each worker process."""

    def __init__(self, spark: SparkSession, value):
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        kept = self._packed.__dict__
        if "_unpacked" not in kept:
            kept["_unpacked"] = cloudpickle.loads(self._packed.value)
        return kept["_unpacked"]
