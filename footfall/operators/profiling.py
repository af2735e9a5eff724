"""Profiling operators: preview, column info, nulls, duplicates, value
distribution, cardinalities, numeric summary and the log overview.

Each one is a single aggregate pass (duplicates: two) and returns rows instead of
printing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import bit_flag, round_half_even
from footfall.operators.selection import as_columns, exact_quantiles
from footfall.session import reliable_checkpoint

# Digests of 16 bytes that a broadcast may hold (some 64 MB in memory).
BROADCAST_DIGESTS = 1 << 20

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, floating_only: bool = False) -> list[str]:
    """Column names selected by type (int/float, or float only)."""
    kinds = (T.FloatType, T.DoubleType) if floating_only else _NUMERIC
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def preview(df: DataFrame, n: int = 5, order_by: str = "row_id") -> DataFrame:
    """The first ``n`` rows in source order (a top-n, not a full sort)."""
    return df.orderBy(order_by).limit(n)


def _long_form(df: DataFrame, exprs: dict[str, F.Column], value_name: str) -> DataFrame:
    """One aggregate row with one column per input column, unpivoted to
    (column, value) rows.  ``position`` keeps the input column order."""
    names = list(exprs)
    one_row = df.agg(*[e.alias(f"c{i}") for i, e in enumerate(exprs.values())])
    pairs = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("column"), F.col(f"c{i}").alias(value_name))
        for i, n in enumerate(names)
    ])
    return one_row.select(F.inline(pairs))


def column_info(df: DataFrame) -> DataFrame:
    """(position, column, dtype, non_null_count) per column, one pass."""
    counts = _long_form(df, {c: F.count(F.col(f"`{c}`")).cast("bigint") for c in df.columns}, "non_null_count")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    dtype = F.create_map(*[x for c in df.columns for x in (F.lit(c), F.lit(types[c]))])
    return counts.select("position", "column", dtype[F.col("column")].alias("dtype"), "non_null_count")


def null_counts(df: DataFrame, top: int | None = None, positive_only: bool = False) -> DataFrame:
    """(position, column, null_count) per column, one pass.

    ``top`` keeps the ``top`` columns with most nulls (ties: input column
    order); ``positive_only`` keeps columns that have nulls at all.
    """
    out = _long_form(df, {c: F.count_if(F.col(f"`{c}`").isNull()).cast("bigint") for c in df.columns}, "null_count")
    if positive_only:
        out = out.where(F.col("null_count") > 0)
    if top is not None:
        out = out.orderBy(F.desc("null_count"), F.asc("position")).limit(top)
    return out


def row_digest(columns: list[str]) -> F.Column:
    """Sixteen bytes for a row: two 64-bit hashes, the second one of the columns in
    reverse behind a constant.  Equal rows have equal digests, not the other way round."""
    own = [F.col(f"`{c}`") for c in columns]
    return F.struct(F.xxhash64(*own).alias("a"), F.xxhash64(F.lit("second"), *reversed(own)).alias("b"))


def duplicate_rows(df: DataFrame, exclude: tuple[str, ...] = ("row_id",), digest=row_digest) -> DataFrame:
    """Full-row duplicates (every copy after the first counts), their ratio
    to all rows (NULL on empty input), and the row count.

    Two stages.  Digests are counted first (after partial aggregation in each task), so the
    shuffle has 16 bytes and a count for a row, however wide the rows are.  Only rows
    whose digest occurs more than once, copies or collisions, go on: they are grouped
    by all their columns, which makes the count exact.  The suspected digests are written
    once; they are broadcast where they are few, and joined by a shuffle otherwise."""
    cols = [c for c in df.columns if c not in exclude]
    counted = df.select(digest(cols).alias("_digest")).groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    rows = Observation("rows")
    counted = counted.observe(rows, F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n"))
    suspects = reliable_checkpoint(counted.where(F.col("_n") > 1).select("_digest"))
    few = suspects.count() <= BROADCAST_DIGESTS
    rest = (df.select(*cols, digest(cols).alias("_digest"))
            .join(F.broadcast(suspects) if few else suspects, "_digest", "left_semi"))
    groups = rest.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    total = F.lit(rows.get["n"]).cast("bigint")
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_cnt")).select(
        "duplicate_cnt", F.when(total > 0, F.col("duplicate_cnt") / total).alias("duplicate_ratio"),
        total.alias("row_cnt"))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distribution of a column including NULL, most frequent first."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).cast("bigint").alias("cnt"))
            .orderBy(F.desc("cnt"), F.asc_nulls_first(column)))


def _id_words(df: DataFrame, columns: list[str], more: list[F.Column]) -> DataFrame:
    """(``_c``, ``_w``, ``_bits``) and the aggregates ``more``: the distinct values of several columns
    in one pass.  A row gives one pair for each column.  Integers are collected 64 to
    a word (``value >> 6``, one bit each), so dense ids shuffle a 64th of their count and sparse
    ones no more than themselves; other types have one word a value.  A null value has
    a null word without bits."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    numeric = all(isinstance(df.schema[c].dataType, whole) for c in columns)
    pairs = []
    for i, c in enumerate(columns):
        if numeric:
            x = F.col(f"`{c}`").cast("bigint")
            word, bits = F.shiftright(x, 6), bit_flag(x.bitwiseAND(F.lit(63)))
        else:
            word = F.col(f"`{c}`").cast("string")
            bits = F.when(word.isNotNull(), F.lit(1).cast("bigint"))
        pairs.append(F.struct(F.lit(i).alias("_c"), word.alias("_w"), bits.alias("_bits")))
    kept = [c for c in df.columns if c not in columns]
    return (df.select(*kept, F.inline(F.array(*pairs))).groupBy("_c", "_w")
            .agg(F.bit_or("_bits").alias("_bits"), *more))


def _distinct(i: int) -> F.Column:
    return F.coalesce(F.sum(F.when(F.col("_c") == i, F.bit_count("_bits"))), F.lit(0)).cast("bigint")


def cardinalities(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-null values per column, as one row, in one pass over the table.

    The values are aggregated as bitmap words of (column, value), with a partial step
    in each task, instead of one distinct aggregate for each column."""
    words = _id_words(df.select(*[F.col(f"`{c}`") for c in columns]), columns, [])
    return words.agg(*[_distinct(i).alias(f"{c}_nunique") for i, c in enumerate(columns)])


def describe_numeric(df: DataFrame, columns: list[str] | None = None, digits: int = 6) -> DataFrame:
    """count, mean, std, min, 25/50/75 % (exact, linear interpolation), max
    per numeric column; mean, std and quartiles are rounded to ``digits``
    decimals (they are display statistics).  The quartiles are selected by interval
    refinement (no value map merged in a single task)."""
    cols = columns or numeric_columns(df)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).cast("bigint").alias(f"n{i}"), F.avg(x).alias(f"mean{i}"),
            F.stddev_samp(x).alias(f"std{i}"), F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}"),
        ]
    quartiles = exact_quantiles(df, [F.col(c) for c in cols], {
        f"q{i}_{int(p * 100)}": (i, p) for i in range(len(cols)) for p in (0.25, 0.5, 0.75)})
    one = df.agg(*aggs).select("*", *as_columns(quartiles))
    rows = F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
            round_half_even(F.col(f"mean{i}"), digits).alias("mean"),
            round_half_even(F.col(f"std{i}"), digits).alias("std"),
            F.col(f"min{i}").alias("min"),
            *[round_half_even(F.col(f"q{i}_{p}"), digits).alias(f"q{p}") for p in (25, 50, 75)],
            F.col(f"max{i}").alias("max"),
        )
        for i, c in enumerate(cols)
    ])
    return one.select(F.inline(rows))


def overview(log: DataFrame) -> DataFrame:
    """Rows, distinct users/items/categories, first and last event time and
    mean events per user, as one row, in one pass: the pairs of the first id column
    carry the counts and times of their events."""
    ids = ["user_id", "item_id", "item_category"]
    first = F.col("_c") == 0
    words = _id_words(log.select(*ids, "timestamp"), ids, [
        F.count_if(first).alias("_n"), F.min(F.when(first, F.col("timestamp"))).alias("_first"),
        F.max(F.when(first, F.col("timestamp"))).alias("_last")])
    return words.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("total_rows"),
        *[_distinct(i).alias(c) for i, c in enumerate(("user_cnt", "item_cnt", "category_cnt"))],
        F.min("_first").alias("first_time"), F.max("_last").alias("last_time"),
    ).select("*", F.when(F.col("user_cnt") > 0, F.col("total_rows") / F.col("user_cnt")).alias("avg_behavior_per_user"))
