"""Coercion rules of the cleaning job (time parsing, missing tokens, ids)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.functions import coerce_behavior, coerce_hour
from footfall.operators.cleaning import clean_log, cleaning_report
from footfall.schemas import MISSING_TOKENS, RAW


@pytest.mark.parametrize("text,expected", [
    ("2024-01-05 10", dt.datetime(2024, 1, 5, 10)),
    ("2024-1-5 9", dt.datetime(2024, 1, 5, 9)),
    ("2024-01-05 00", dt.datetime(2024, 1, 5, 0)),
    ("2024-01-05 24", None),
    ("2024-01-05 10:30", None),
    ("2024-01-05", None),
    ("2024-02-30 10", None),
    ("bad", None),
])
def test_coerce_hour(spark, text, expected):
    got = spark.range(1).select(coerce_hour(F.lit(text)).alias("t")).first().t
    assert got == expected


@pytest.mark.parametrize("text,expected", [("1", 1.0), ("1.0", 1.0), (" 4 ", 4.0), ("x", None), ("9", 9.0)])
def test_coerce_behavior(spark, text, expected):
    assert spark.range(1).select(coerce_behavior(F.lit(text)).alias("b")).first().b == expected


def test_missing_tokens_are_dropped(spark):
    rows = [(i, tok, "1", "1", "1", "2024-01-05 10") for i, tok in enumerate(MISSING_TOKENS)]
    rows += [(100, "Null", "1", "1", "1", "2024-01-05 10")]  # case-sensitive: kept, but not numeric
    raw = spark.createDataFrame(rows[:-1], RAW)
    rep = cleaning_report(raw).first()
    assert rep.missing_user_id == len(MISSING_TOKENS) and rep.rows_kept == 0


def test_non_numeric_id_fails_loudly(spark):
    raw = spark.createDataFrame([(1, "abc", "1", "1", "1", "2024-01-05 10")], RAW)
    with pytest.raises(Exception, match="non-numeric id"):
        clean_log(raw).collect()
    kept = clean_log(raw, id_kind="string").collect()
    assert kept[0].user_id == "abc"


def test_integral_text_ids(spark):
    raw = spark.createDataFrame([(1, "12.0", " 7 ", "1", "3", "2024-01-05 10")], RAW)
    row = clean_log(raw).first()
    assert (row.user_id, row.item_id, row.item_category) == (12, 7, 3)
