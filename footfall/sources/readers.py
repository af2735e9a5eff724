"""Readers for raw logs (CSV) and feature tables (Parquet)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.schemas import LOG, RAW_COLUMNS


ID_COLUMNS = ("user_id", "item_id", "item_category")

def _bytes(spark: SparkSession, key: str) -> int:
    """A size setting of the session in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def _file_order_id(df: DataFrame, path: str) -> DataFrame:
    """``df`` with ``row_id`` following (file path, offset in the file, line).

    Spark deals splits to tasks by size, so ``monotonically_increasing_id`` alone
    doesn't follow the files.  A split's place is known without reading any row: the
    listing gives the files' paths and sizes, and a split starts at a multiple of a
    size that is never below the smaller of two settings, so the start divided by that
    unit tells the splits of a file apart.  ``row_id`` is the units of all files before,
    plus the split's own, shifted to leave room for the position inside the task (which
    runs through all its splits).  The table of files has one row (16 bytes) for each
    file and is broadcast."""
    spark = df.sparkSession
    unit = min(_bytes(spark, f"spark.sql.files.{k}") for k in ("maxPartitionBytes", "openCostInBytes"))
    units = F.floor(F.col("_size") / F.lit(max(1, unit))).cast("bigint") + 1
    # Listed only: the files' content is not a column here.
    listed = (spark.read.format("binaryFile").load(path)
              .select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size")))
    before = F.sum(units).over(Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1))
    files = listed.select(F.xxhash64("_path").alias("_file"), F.coalesce(before, F.lit(0)).alias("_before"))
    total = listed.agg(F.coalesce(F.sum(units), F.lit(0)).alias("n")).first().n
    shift = 62 - max(1, int(total)).bit_length()
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start = F.floor(F.col("_metadata.file_block_start") / F.lit(max(1, unit))).cast("bigint")
    placed = df.select("*", F.xxhash64("_metadata.file_path").alias("_file"), start.alias("_start"),
                       position.alias("_position"))
    fits = F.when(F.col("_position") < F.lit(1 << min(shift, 33)), F.col("_position")).otherwise(
        F.raise_error(F.lit("more rows in a task than row ids for it: lower spark.sql.files.maxPartitionBytes")).cast("bigint"))
    return (placed.join(F.broadcast(files), "_file")
            .withColumn("row_id", F.shiftleft(F.col("_before") + F.col("_start"), shift) + fits))


def read_raw(spark: SparkSession, path: str, row_id_column: str | None = None,
             spread: int | None = None) -> DataFrame:
    """Read a raw behaviour CSV with a header; every column is read as text.

    ``row_id`` (source order, breaks same-hour ties) is taken from
    ``row_id_column`` when the file carries an event id; otherwise it follows the
    order of the files' paths and of the lines in them.  ``spread`` deals the rows
    to that many partitions, for input in a few files that can't be split (gzip).
    The required columns are checked before anything runs.
    """
    from footfall.operators.cleaning import require_columns

    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    require_columns(df, RAW_COLUMNS)
    if row_id_column:
        df = df.withColumn("row_id", F.col(row_id_column).cast("bigint"))
    else:
        df = _file_order_id(df, path)
    # row_id is taken before any repartitioning, so it keeps the file order.
    rows = df.select("row_id", *[F.col(c).cast("string") for c in RAW_COLUMNS])
    return rows.repartition(spread) if spread else rows


def read_log(spark: SparkSession, path: str, fmt: str = "parquet", with_date: bool = False,
             id_kind: str = "bigint") -> DataFrame:
    """Read a clean LOG written by :func:`footfall.sources.sinks.write_log`, with
    ids of the kind that :func:`footfall.operators.cleaning.clean_log` gave them.

    Text that doesn't fit its column fails the read.  ``with_date`` adds the
    partition column of a log laid out by date: a filter on it prunes folders.
    """
    fields = [T.StructField(f.name, T.StringType()) if id_kind == "string" and f.name in ID_COLUMNS else f
              for f in LOG.fields]
    schema = T.StructType([*fields, T.StructField("date", T.DateType())] if with_date else fields)
    if fmt == "csv":
        df = (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
              .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    else:
        df = spark.read.schema(schema).parquet(path)
    return df.select(*schema.fieldNames())


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Read a feature table written as Parquet."""
    return spark.read.parquet(path)
