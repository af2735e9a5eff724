"""The cleaning job over arriving raw CSV files (Structured Streaming).

The reference has no streaming layer; this is the same ``clean_log``
operator run incrementally: a file-stream source with the raw text schema, the
narrow cleaning stage (no state, no shuffle), and a Parquet file sink.  The
stream's state lives with its sink (``<sink>/_state``), so two streams never
share it and a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from footfall.operators.cleaning import clean_log
from footfall.schemas import RAW_COLUMNS


def raw_stream(spark: SparkSession, source_dir: str, row_id_column: str = "row_id",
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw behaviour CSV files (with header) arriving in ``source_dir``.

    ``row_id_column`` names the source event id that orders same-hour events.
    It is required: arriving files have no order of their own, and a row without
    an id fails the stream instead of giving wrong sequences later.
    """
    if not row_id_column:
        raise ValueError("a stream needs a source event id column")
    fields = [T.StructField(c, T.StringType()) for c in (row_id_column, *RAW_COLUMNS)]
    reader = spark.readStream.schema(T.StructType(fields)).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.csv(source_dir)
    row_id = F.col(row_id_column).cast("bigint")
    checked = F.when(row_id.isNull(), F.raise_error("event without an id").cast("bigint")).otherwise(row_id)
    return df.select(checked.alias("row_id"), *RAW_COLUMNS)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def start_clean_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_location: str | None = None,
                       available_now: bool = True, row_id_column: str = "row_id",
                       id_kind: str = "bigint") -> StreamingQuery:
    """Start the incremental cleaning query; returns the running query.

    ``available_now`` processes every file present and stops (a repeatable
    batch-style run); otherwise the query keeps polling for new files.  A sink
    that a stream has written with another state is refused: its log would make
    the sink skip the new stream's first batches.
    """
    location = checkpoint_location or f"{sink_dir.rstrip('/')}/_state"
    if _exists(spark, f"{sink_dir.rstrip('/')}/_spark_metadata") and not _exists(spark, f"{location}/offsets"):
        raise ValueError(f"{sink_dir} holds a stream's output, but {location} holds no state of it")
    writer = (clean_log(raw_stream(spark, source_dir, row_id_column), id_kind)
              .writeStream.format("parquet")
              .option("path", sink_dir)
              .option("checkpointLocation", location)
              .outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
