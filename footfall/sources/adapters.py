"""Adapters from the generated test tables to the behaviour-log shapes.

``events_raw``   ``events`` -> RAW (dirty text log; spec in FIXTURES.md §2)
``lineitem_log`` ``lineitem`` join ``orders`` -> LOG (scale fixture, §3)

Both read only the columns they need, so the Parquet scan prunes the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table rewritten as a raw behaviour log (all text)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    # ``props`` is ``{"k": N}``: take the text after ': ' up to '}' (cheap
    # string functions; the cleaning filter is pushed below this projection,
    # so every reference to ``k`` is evaluated again there).
    k = F.trim(F.substring_index(F.substring_index("props", ":", -1), "}", 1)).cast("int")
    et, value = F.col("event_type"), F.col("value")
    behavior = (
        F.when(k == 99, F.lit("x"))
        .when(k == 96, F.lit("2d"))
        .when(k == 95, F.lit("1f"))
        .when(et.isin("view", "click"), F.lit("1"))
        .when(et == "signup", F.when(value < 35, F.lit("2")).otherwise(F.lit("3")))
        .when(et == "purchase", F.when(value >= 100, F.lit("4")).otherwise(F.lit("1")))
        .when(et == "error", F.lit("9"))
    )
    return ev.select(
        F.col("event_id").alias("row_id"),
        F.when(k == 98, F.lit(None).cast("string")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
        (k % 20).cast("string").alias("item_id"),
        behavior.alias("behavior_type"),
        ((k % 20) % 5).cast("string").alias("item_category"),
        F.when(k == 97, F.lit("bad"))
        .when(k == 94, F.lit("1500-01-01 05"))
        .when(k == 93, F.lit("3000-01-01 05"))
        .otherwise(F.date_format(F.col("ts").cast("timestamp_ntz"), "yyyy-MM-dd HH"))
        .alias("time"),
    )


def lineitem_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean LOG built from ``lineitem`` x ``orders`` (one event per line item).

    ``row_id`` carries no source order here ((orderkey, linenumber) is not
    unique in the generated data), so only order-free features are valid on it.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    behavior = (
        F.when(rf == "N", F.lit(1))
        .when((rf == "A") & (ls == "F"), F.lit(1))
        .when((rf == "A") & (ls == "O"), F.lit(2))
        .when((rf == "R") & (ls == "F"), F.lit(3))
        .when((rf == "R") & (ls == "O"), F.lit(4))
    )
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    return joined.select(
        (F.col("l_orderkey") * F.lit(16) + F.col("l_linenumber")).cast("bigint").alias("row_id"),
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("item_id"),
        behavior.cast("int").alias("behavior_type"),
        (F.col("l_partkey") % 50).cast("bigint").alias("item_category"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
    ).where(F.col("behavior_type").isNotNull())
