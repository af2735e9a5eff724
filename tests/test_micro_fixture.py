"""Hand-derived values of the micro fixture (FIXTURES.md §4)."""

import datetime as dt

import pytest

from footfall.operators.cleaning import clean_log, cleaning_report
from footfall.operators.profiling import duplicate_rows
from footfall.plans.user_features import UserFeatures
from footfall.schemas import RAW

ROWS = [
    (1, "1", "10", "1", "100", "2024-01-05 10"),
    (2, "1", "10", "4", "100", "2024-01-05 10"),
    (3, "1", "11", "1", "101", "2024-01-06 23"),
    (4, "1", "11", "3", "101", "2024-01-07 00"),
    (5, "1", "11", "4", "101", "2024-01-07 03"),
    (6, "1", "10", "4", "100", "2024-01-09 10"),
    (7, "2", "10", "1", "100", "2024-01-05 05"),
    (8, "2", "10", "1", "100", "2024-01-05 06"),
    (9, "2", "12", "3", "100", "2024-01-05 06"),
    (10, "2", "12", "3", "100", "2024-01-06 12"),
    (11, "3", "13", "4", "102", "2024-01-08 18"),
    (12, "4", "11", "4", "101", "2024-01-02 09"),
    (13, "4", "11", "1", "101", "2024-01-02 10"),
    (14, "4", "14", "2", "102", "2024-01-03 09"),
    (15, "4", "13", "1", "102", "2024-01-04 09"),
    (16, "4", "14", "1", "102", "2024-01-04 09"),
    (17, "5", "10", "9", "100", "2024-01-05 10"),
    (18, "5", "10", "x", "100", "2024-01-05 10"),
    (19, "5", "10", "1", "100", "2024-01-05"),
    (20, None, "10", "1", "100", "2024-01-05 10"),
    (21, "1", "10", "1", "100", "2024-01-05 10"),
    (22, "5", "10", "1", "100", "2024-01-05 24"),
]

# user -> expected values (FIXTURES.md §4 table)
EXPECTED = {
    "total_behavior_cnt": [7, 4, 1, 5], "pv_cnt": [3, 2, 0, 3], "fav_cnt": [0, 0, 0, 1],
    "cart_cnt": [1, 2, 0, 0], "buy_cnt": [3, 0, 1, 1],
    "active_days": [4, 2, 1, 3], "user_lifetime_days": [5, 2, 1, 3],
    "pv_buy_ratio": [1.0, 0.0, None, 0.3333], "cart_buy_ratio": [3.0, 0.0, None, None],
    "hesitation_score": [1.0, None, 0.0, 3.0],
    "late_night_behavior_cnt": [2, 1, 0, 0], "morning_behavior_cnt": [4, 2, 0, 5],
    "afternoon_behavior_cnt": [0, 1, 0, 0], "evening_behavior_cnt": [1, 0, 1, 0],
    "weekend_behavior_cnt": [3, 1, 0, 0],
    "top_item_id": [10, 10, 13, 11], "top_item_behavior_cnt": [4, 2, 1, 2],
    "top_category_id": [100, 100, 102, 102], "top_category_behavior_cnt": [4, 4, 1, 3],
    "repeat_view_item_cnt": [1, 1, 0, 0], "repeat_buy_item_cnt": [1, 0, 0, 0],
    "repeat_view_without_buy": [0, 1, 0, 0],
    "avg_steps_to_buy": [4.0, None, 0.0, 0.0], "first_buy_interval": [0.0, None, None, None],
    "avg_buy_interval": [48.0, None, None, None], "view_before_first_buy_cnt": [0, 0, 0, 0],
    "impulsive_buy_flag": [True, False, False, False], "category_shift_cnt": [2, 0, 0, 1],
    "max_consecutive_active_days": [3, 2, 1, 3], "avg_consecutive_active_days": [2.0, 2.0, 1.0, 3.0],
    "dominant_category_stability": [2, 2, 1, 2], "recent_7d_behavior_cnt": [7, 4, 1, 3],
    "inactive_gap_days": [0, 3, 1, 5],
    "long_cart_no_buy_flag": [False, True, False, False],
    "high_value_user_flag": [True, False, False, False],
    "high_conversion_user_flag": [True, False, False, False],
    "user_maturity_stage": ["mature_user", "normal_user", "new_user", "silent_user"],
    "retention_score": [93.12, 52.5, 28.75, 60.62],
}


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, RAW)


@pytest.fixture(scope="module")
def users(raw):
    log = clean_log(raw)
    return {r["user_id"]: r.asDict() for r in UserFeatures(log).table().collect()}


def test_cleaning_counts(raw):
    rep = cleaning_report(raw).first()
    assert (rep.rows_in, rep.rows_kept, rep.rows_removed) == (22, 17, 5)
    assert duplicate_rows(raw).first().duplicate_cnt == 1
    log = clean_log(raw)
    assert sorted(r.user_id for r in log.select("user_id").distinct().collect()) == [1, 2, 3, 4]
    assert log.count() == 17  # the duplicate row 21 is kept


def test_log_types(raw):
    log = clean_log(raw)
    assert dict(log.dtypes) == {"row_id": "bigint", "user_id": "bigint", "item_id": "bigint",
                                "behavior_type": "int", "item_category": "bigint", "timestamp": "timestamp_ntz"}
    first = log.orderBy("row_id").first()
    assert first.timestamp == dt.datetime(2024, 1, 5, 10)


@pytest.mark.parametrize("column", sorted(EXPECTED))
def test_user_column(users, column):
    got = [users[u][column] for u in (1, 2, 3, 4)]
    assert got == EXPECTED[column], column


def test_user_table_shape(users):
    from footfall.schemas import USER_COLUMNS

    assert list(users[1]) == USER_COLUMNS
    assert len(USER_COLUMNS) == 100
