"""Validation and cleaning of the raw behaviour log (one narrow stage)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from footfall.functions import checked_id, coerce_behavior, hour_in_range, id_value, missing_to_null, parsed_hour
from footfall.schemas import RAW_COLUMNS


def require_columns(df: DataFrame, columns: list[str]) -> None:
    """Raise ``ValueError`` when a required column is missing (no job runs)."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def evaluated_once(df: DataFrame) -> DataFrame:
    """``df`` behind a projection that the optimizer neither merges with later ones nor
    pushes filters through.  Otherwise a filter on a parsed column copies the whole
    expression below the projection, once for every reference to it."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def normalized(raw: DataFrame) -> DataFrame:
    """RAW with missing-value tokens turned into NULL in every text column."""
    require_columns(raw, RAW_COLUMNS)
    return raw.select("row_id", *[missing_to_null(c).alias(c) for c in RAW_COLUMNS])


def coerced(raw: DataFrame) -> DataFrame:
    """RAW plus the coerced behaviour number and hour timestamp."""
    texts = evaluated_once(normalized(raw))
    parsed = evaluated_once(texts.withColumns({"behavior_num": coerce_behavior("behavior_type"),
                                               "ts": parsed_hour("time")}))
    return parsed.withColumn("ts", hour_in_range("ts"))


def _valid_behavior(col: str = "behavior_num"):
    return F.col(col).isin(1.0, 2.0, 3.0, 4.0)


def clean_log(raw: DataFrame, id_kind: str = "bigint", report: Observation | None = None) -> DataFrame:
    """RAW -> LOG.

    Coerce behaviour to a number and time to an hour timestamp, drop rows
    with a missing key field, keep behaviour codes 1-4, cast and rename
    ``time`` to ``timestamp``.  Duplicate rows are kept.  Narrow: no shuffle.
    ``report`` gets the counts of :func:`cleaning_report` from the first action on
    the log (which must not run the cleaning twice, as a sampling range shuffle would).
    """
    c = coerced(raw)
    return kept_rows(c.observe(report, *report_counts()) if report else c, id_kind)


def kept_rows(coerced_raw: DataFrame, id_kind: str = "bigint") -> DataFrame:
    """The valid rows of :func:`coerced` as LOG."""
    kept = coerced_raw.where(
        F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
        & F.col("item_category").isNotNull() & F.col("ts").isNotNull()
        & _valid_behavior()
    )
    ids = ("user_id", "item_id", "item_category")
    if id_kind == "string":
        values = {c: F.col(c) for c in ids}
    elif id_kind == "bigint":
        # The parsed ids are computed in their own projection and referenced
        # twice above it (value and check), so each is parsed once per row.
        kept = kept.select("*", *[id_value(c).alias(f"_{c}") for c in ids])
        values = {c: checked_id(c, f"_{c}") for c in ids}
    else:
        raise ValueError(f"unknown id kind {id_kind!r}")
    return kept.select(
        F.col("row_id").cast("bigint").alias("row_id"),
        values["user_id"].alias("user_id"),
        values["item_id"].alias("item_id"),
        F.col("behavior_num").cast("int").alias("behavior_type"),
        values["item_category"].alias("item_category"),
        F.col("ts").alias("timestamp"),
    )


def report_counts() -> list[Column]:
    """Aggregates over :func:`coerced`: rows in, rows kept, rows removed, and the count
    per reason (a row may have several reasons)."""
    missing_key = (F.col("user_id").isNull() | F.col("item_id").isNull()
                   | F.col("item_category").isNull())
    invalid_behavior = ~F.coalesce(_valid_behavior(), F.lit(False))
    invalid_time = F.col("ts").isNull()
    kept = ~missing_key & ~invalid_behavior & ~invalid_time
    return [
        F.count(F.lit(1)).cast("bigint").alias("rows_in"),
        F.count_if(kept).cast("bigint").alias("rows_kept"),
        F.count_if(~kept).cast("bigint").alias("rows_removed"),
        F.count_if(F.col("user_id").isNull()).cast("bigint").alias("missing_user_id"),
        F.count_if(F.col("item_id").isNull()).cast("bigint").alias("missing_item_id"),
        F.count_if(F.col("item_category").isNull()).cast("bigint").alias("missing_item_category"),
        F.count_if(invalid_behavior).cast("bigint").alias("invalid_behavior"),
        F.count_if(invalid_time).cast("bigint").alias("invalid_time"),
    ]


def cleaning_report(raw: DataFrame) -> DataFrame:
    """One row with the :func:`report_counts` of the raw log, as a pass of its own; a job
    that writes the log takes them from that write."""
    return coerced(raw).agg(*report_counts())


def invalid_behavior(raw: DataFrame) -> DataFrame:
    """Every raw row whose behaviour is missing, non-numeric or outside 1-4."""
    c = coerced(raw)
    return c.where(~F.coalesce(_valid_behavior(), F.lit(False))).select("row_id", *RAW_COLUMNS)


def invalid_time(raw: DataFrame) -> DataFrame:
    """Every raw row whose time does not parse as ``YYYY-MM-DD HH``."""
    c = coerced(raw)
    return c.where(F.col("ts").isNull()).select("row_id", *RAW_COLUMNS)
