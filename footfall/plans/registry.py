"""Query registry: one callable per operator family, each taking
``(spark, sf_dir)`` and returning a DataFrame over the whole input tables,
plus the independent DuckDB oracle for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from footfall.operators.cleaning import clean_log
from footfall.plans import oracle_sql as O
from footfall.plans.entity_features import ENTITIES, FAMILY_COLUMNS, EntityFeatures
from footfall.plans.user_features import FAMILIES, UserFeatures
from footfall.schemas import USER_COLUMNS
from footfall.session import reliable_checkpoint
from footfall.sources.adapters import events_raw

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean LOG of the main fixture (``events`` -> RAW -> LOG)."""
    return clean_log(events_raw(spark, sf_dir))


def feature_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log that feature queries read.  It isn't copied: cleaning is a narrow
    projection, and the rollups (which are materialized) read it once each."""
    return events_log(spark, sf_dir)


# ----- user table ---------------------------------------------------------

def _family_query(name: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        sequences = name not in UserFeatures.COUNT_FAMILIES
        return UserFeatures(feature_log(spark, sf_dir), sequences=sequences).family(name)
    q.__name__ = name
    return q


for _name, _cols in FAMILIES.items():
    register(_name, O.user_sql(["user_id"] + _cols))(_family_query(_name))


@register("user_feature_table", O.user_sql(USER_COLUMNS))
def user_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserFeatures(feature_log(spark, sf_dir)).table()


# Text ids (a letter before the number): ties between ids then follow text order.
_TEXT_IDS = {"user_id": "u", "item_id": "i", "item_category": "c"}


def _text_id_sql() -> str:
    sql = O.user_sql(USER_COLUMNS)
    for column, letter in _TEXT_IDS.items():
        sql = sql.replace(f"CAST({column} AS BIGINT) AS {column}", f"('{letter}' || {column}) AS {column}", 1)
    return sql


@register("string_id_user_table", _text_id_sql())
def string_id_user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = events_raw(spark, sf_dir)
    text = raw.withColumns({c: F.concat(F.lit(letter), F.col(c)) for c, letter in _TEXT_IDS.items()})
    return UserFeatures(clean_log(text, id_kind="string")).table()


@register("user_thresholds", O.user_thresholds_sql())
def user_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return UserFeatures(feature_log(spark, sf_dir)).thresholds()


# ----- item and category tables --------------------------------------------

def _entity_query(key: str, family: str | None) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        ef = EntityFeatures(feature_log(spark, sf_dir), key)
        return ef.table() if family is None else ef.family(family)
    return q


for _key, _spec in ENTITIES.items():
    _prefix = _spec["prefix"]
    for _fam in FAMILY_COLUMNS:
        if _fam == "concentration" and _key == "item_id":
            continue
        _cols = EntityFeatures.__new__(EntityFeatures)
        _cols.key, _cols.spec = _key, _spec
        register(f"{_prefix}_{_fam}", O.entity_sql(_key, _cols.family_columns(_fam)))(_entity_query(_key, _fam))
    register(f"{_prefix}_feature_table", O.entity_sql(_key, _spec["columns"]))(_entity_query(_key, None))


# ----- sources, cleaning, profiling ----------------------------------------

from footfall.operators import cleaning as C  # noqa: E402
from footfall.operators import profiling as P  # noqa: E402
from footfall.operators import sequences as S  # noqa: E402
from footfall.operators.ranking import pct_ranks  # noqa: E402
from footfall.operators.rollups import enrich  # noqa: E402
from footfall.functions import behavior_name, round_half_even, safe_ratio  # noqa: E402
from footfall.sources import readers, sinks  # noqa: E402
from footfall.plans.user_features import finish  # noqa: E402

X = O.ORACLE_EXTRA


@register("raw_behavior", X["raw_behavior"])
def raw_behavior(spark, sf_dir):
    return events_raw(spark, sf_dir)


@register("clean_log", X["clean_log"])
def clean_log_query(spark, sf_dir):
    return events_log(spark, sf_dir)


@register("cleaning_report", X["cleaning_report"])
def cleaning_report(spark, sf_dir):
    return C.cleaning_report(events_raw(spark, sf_dir))


@register("csv_roundtrip", X["csv_roundtrip"])
def csv_roundtrip(spark, sf_dir):
    """Clean log written as CSV to the shared checkpoint folder and read back."""
    path = sinks.scratch_path(spark, "csv")
    sinks.write_log(events_log(spark, sf_dir), path, fmt="csv")
    return readers.read_log(spark, path, fmt="csv")


@register("parquet_roundtrip", X["parquet_roundtrip"])
def parquet_roundtrip(spark, sf_dir):
    """Clean log written as Parquet (partitioned by date) and read back."""
    path = sinks.scratch_path(spark, "parquet")
    sinks.write_log(events_log(spark, sf_dir), path, fmt="parquet", partition_by_date=True)
    return readers.read_log(spark, path, fmt="parquet")


@register("publish_and_count", X["publish_and_count"])
def publish_and_count(spark, sf_dir):
    """Create the database, replace the table with the clean log, compare its count
    with the rows that the write observed."""
    sinks.ensure_database(spark, "footfall", location=sinks.scratch_path(spark, "database"))
    report = Observation("cleaning report")
    name = sinks.publish_table(clean_log(events_raw(spark, sf_dir), report=report), "user_behavior", database="footfall",
                               path=sinks.scratch_path(spark, "table"))
    return sinks.verify_published(sinks.published(spark, name), report.get["rows_kept"])


@register("preview", X["preview"])
def preview(spark, sf_dir):
    return P.preview(events_raw(spark, sf_dir), 5)


@register("column_info", X["column_info"])
def column_info(spark, sf_dir):
    return P.column_info(events_raw(spark, sf_dir))


@register("null_counts", X["null_counts"])
def null_counts(spark, sf_dir):
    return P.null_counts(events_raw(spark, sf_dir))


@register("feature_table_roundtrip", O.entity_sql("item_id", ENTITIES["item_id"]["columns"]))
def feature_table_roundtrip(spark, sf_dir):
    """The item table written by its sink and read back, as the quality job reads it."""
    path = sinks.scratch_path(spark, "features")
    sinks.write_features(EntityFeatures(feature_log(spark, sf_dir), "item_id").table(), path)
    return readers.read_features(spark, path)


@register("top_null_columns", O.top_null_columns_sql(USER_COLUMNS, 20))
def top_null_columns(spark, sf_dir):
    return P.null_counts(UserFeatures(feature_log(spark, sf_dir)).table(), top=20)


@register("duplicate_rows", X["duplicate_rows"])
def duplicate_rows(spark, sf_dir):
    return P.duplicate_rows(events_raw(spark, sf_dir))


@register("behavior_distribution", X["behavior_distribution"])
def behavior_distribution(spark, sf_dir):
    return P.value_counts(events_raw(spark, sf_dir), "behavior_type")


@register("invalid_behavior", X["invalid_behavior"])
def invalid_behavior(spark, sf_dir):
    return C.invalid_behavior(events_raw(spark, sf_dir))


@register("invalid_time", X["invalid_time"])
def invalid_time(spark, sf_dir):
    return C.invalid_time(events_raw(spark, sf_dir))


@register("cardinalities", X["cardinalities"])
def cardinalities(spark, sf_dir):
    return P.cardinalities(events_raw(spark, sf_dir), ["user_id", "item_id", "item_category"])


@register("describe_numeric", X["describe_numeric"])
def describe_numeric(spark, sf_dir):
    items = EntityFeatures(feature_log(spark, sf_dir), "item_id").table()
    return P.describe_numeric(items, O.DESCRIBE_ITEM_COLUMNS)


@register("overview", X["overview"])
def overview(spark, sf_dir):
    return P.overview(feature_log(spark, sf_dir))


# ----- projections, rollups, top-k, sequences -------------------------------

@register("enriched_log", X["enriched_log"])
def enriched_log(spark, sf_dir):
    # ``date`` is reported as a midnight timestamp, the reference's representation.
    return (enrich(events_log(spark, sf_dir))
            .withColumns({"date": F.col("date").cast("timestamp_ntz"), "behavior": behavior_name("behavior_type")}))


_SEQUENCE_QUERIES = {"views_before_first_buy", "category_shifts"}


def _user_cols(name: str, block: str, cols: list[str]) -> None:
    def q(spark, sf_dir):
        uf = UserFeatures(feature_log(spark, sf_dir), sequences=block == "base" or name in _SEQUENCE_QUERIES)
        return finish(getattr(uf, block), ["user_id"] + cols)
    register(name, O.user_columns_sql(["user_id"] + cols))(q)


_user_cols("hour_band_counts", "hour_block", ["late_night_behavior_cnt", "morning_behavior_cnt",
                                              "afternoon_behavior_cnt", "evening_behavior_cnt"])
_user_cols("weekend_split", "hour_block", ["weekend_behavior_cnt", "weekday_behavior_cnt"])
_user_cols("hour_slots", "hour_block", ["active_hour_cnt", "active_2h_slot", "active_3h_slot", "active_6h_slot"])
_user_cols("behavior_pivot", "hour_block", ["pv_cnt", "fav_cnt", "cart_cnt", "buy_cnt"])
_user_cols("daily_extremes", "day_block", ["max_daily_behavior_cnt", "min_daily_behavior_cnt"])
_user_cols("distinct_by_behavior", "item_block", ["viewed_item_cnt", "bought_item_cnt", "cart_item_cnt",
                                                  "fav_item_cnt"])
_user_cols("repeat_pairs", "item_block", ["repeat_view_item_cnt", "repeat_buy_item_cnt"])
_user_cols("top_hour", "hour_block", ["peak_active_hour"])
_user_cols("top_slot_6h", "hour_block", ["peak_6h_slot"])
_user_cols("top_item", "item_block", ["top_item_id", "top_item_behavior_cnt"])
_user_cols("top_category", "category_block", ["top_category_id", "top_category_behavior_cnt"])
_user_cols("repeat_view_without_buy", "item_block", ["repeat_view_without_buy"])
_user_cols("views_before_first_buy", "hour_block", ["view_before_first_buy_cnt"])
_user_cols("category_shifts", "hour_block", ["category_shift_cnt"])
_user_cols("active_streaks", "day_block", ["max_consecutive_active_days", "avg_consecutive_active_days"])
_user_cols("category_streaks", "category_streak_block", ["dominant_category_stability"])
_user_cols("recent_activity", "day_block", ["recent_3d_behavior_cnt", "recent_7d_behavior_cnt",
                                            "recent_3d_buy_cnt", "recent_7d_buy_cnt"])
_user_cols("inactive_gap", "day_block", ["inactive_gap_days"])
_user_cols("first_buy_interval", "base", ["first_buy_interval"])
_user_cols("impulsive_users", "base", ["impulsive_buy_flag"])
_user_cols("steps_to_buy", "base", ["avg_steps_to_buy"])
_user_cols("buy_gaps", "base", ["avg_buy_interval"])


@register("top_category_per_day", X["top_category_per_day"])
def top_category_per_day(spark, sf_dir):
    daily = UserFeatures(feature_log(spark, sf_dir)).daily_top_category
    return daily.withColumn("date", F.col("date").cast("timestamp_ntz"))


@register("last_view_before_buy", X["last_view_before_buy"])
def last_view_before_buy(spark, sf_dir):
    return UserFeatures(feature_log(spark, sf_dir)).last_view_before_buy


@register("view_buy_pairs", X["view_buy_pairs"])
def view_buy_pairs(spark, sf_dir):
    return S.view_buy_pairs(UserFeatures(feature_log(spark, sf_dir)).user_item_hour)


@register("event_order", X["event_order"])
def event_order(spark, sf_dir):
    return S.event_order(S.in_parts(UserFeatures(feature_log(spark, sf_dir)).events))


@register("pct_rank_active_days", X["pct_rank_active_days"])
def pct_rank_active_days(spark, sf_dir):
    days = UserFeatures(feature_log(spark, sf_dir)).day_block.select("user_id", "active_days")
    return pct_ranks(days, {"active_days": "pct_rank_active_days"})


# ----- quality reports ----------------------------------------------------------

from footfall.operators import quality as Q  # noqa: E402


# The quality job reads the written feature tables, as the reconciliation of
# the reference reads the tables its feature jobs wrote.

def _user_table_and_log(spark, sf_dir):
    log = feature_log(spark, sf_dir)
    return log, reliable_checkpoint(UserFeatures(log).table())


def _entity_table_and_log(spark, sf_dir, key):
    log = feature_log(spark, sf_dir)
    return log, reliable_checkpoint(EntityFeatures(log, key).table())


@register("quality_user", O.quality_user_sql())
def quality_user(spark, sf_dir):
    log, users = _user_table_and_log(spark, sf_dir)
    checks = Q.user_checks(users.columns, P.numeric_columns(users))
    return Q.quality_report(log, users, "user", checks, "user_id")


@register("quality_item", O.quality_entity_sql("item_id"))
def quality_item(spark, sf_dir):
    log, items = _entity_table_and_log(spark, sf_dir, "item_id")
    return Q.quality_report(log, items, "item", Q.entity_checks("item_id", items.columns), "item_id")


@register("quality_category", O.quality_entity_sql("item_category"))
def quality_category(spark, sf_dir):
    log, cats = _entity_table_and_log(spark, sf_dir, "item_category")
    return Q.quality_report(log, cats, "category", Q.entity_checks("item_category", cats.columns), "item_category")


@register("reconcile_all_users", O.reconcile_sql("user_id", O.ALL_USER_CTES + [O.user_table_cte()], "u_table"))
def reconcile_all_users(spark, sf_dir):
    log, users = _user_table_and_log(spark, sf_dir)
    return Q.reconcile_all(log, users, "user_id")


@register("reconcile_all_items",
          O.reconcile_sql("item_id", O.entity_ctes("item_id") + [O.entity_table_cte("item_id")], "e_table"))
def reconcile_all_items(spark, sf_dir):
    log, items = _entity_table_and_log(spark, sf_dir, "item_id")
    return Q.reconcile_all(log, items, "item_id")


@register("reconcile_all_categories",
          O.reconcile_sql("item_category", O.entity_ctes("item_category") + [O.entity_table_cte("item_category")],
                          "e_table"))
def reconcile_all_categories(spark, sf_dir):
    log, cats = _entity_table_and_log(spark, sf_dir, "item_category")
    return Q.reconcile_all(log, cats, "item_category")


_TABLES = {
    "user_id": ("user", USER_COLUMNS, O.ALL_USER_CTES + [O.user_table_cte()], "u_table"),
    **{k: (spec["prefix"], spec["columns"], O.entity_ctes(k) + [O.entity_table_cte(k)], "e_table")
       for k, spec in ENTITIES.items()},
}


def _table_query(key: str, check: bool) -> Query:
    def q(spark, sf_dir):
        log, rows = (_user_table_and_log(spark, sf_dir) if key == "user_id"
                     else _entity_table_and_log(spark, sf_dir, key))
        return Q.sampled_entity_check(log, rows, key, seed=42) if check else P.describe_numeric(rows)
    return q


for _key, (_name, _cols, _ctes, _table) in _TABLES.items():
    # Seeded spot check of one entity, and all eight statistics of every numeric column.
    register("sampled_entity_check" if _key == "user_id" else f"sampled_{_name}_check",
             O.sampled_sql(_key, _ctes, _table))(_table_query(_key, True))
    register(f"describe_{_name}", O.describe_sql(_ctes, _table, O.numeric_columns(_cols)))(_table_query(_key, False))


@register("raw_csv_clean", O.RAW_CSV_SQL)
def raw_csv_clean(spark, sf_dir):
    """The raw log as CSV files of different sizes, read back in file order,
    cleaned, and every event numbered in its user's order."""
    raw = events_raw(spark, sf_dir)
    path = sinks.scratch_path(spark, "raw-csv")
    cut = raw.agg((F.min("row_id") + (F.max("row_id") - F.min("row_id")) / 10).cast("bigint").alias("cut"))
    marked = raw.crossJoin(F.broadcast(cut))
    for part, rows in (("part=0", marked.where("row_id <= cut")), ("part=1", marked.where("row_id > cut"))):
        (rows.repartitionByRange(3, "row_id").sortWithinPartitions("row_id").drop("cut", "row_id")
         .write.option("header", True).csv(f"{path}/{part}"))
    log = C.clean_log(readers.read_raw(spark, path))
    order = S.event_order(S.in_parts(UserFeatures(log).events))
    return log.join(order, ["row_id", "user_id"]).select(
        "user_id", "timestamp", "item_id", "behavior_type", "behavior_order")


# ----- scale fixture: lineitem x orders as the log ------------------------------
# Order-free families only: row_id carries no source order on this fixture.

from footfall.sources.adapters import lineitem_log  # noqa: E402


def _scale_user(family: str) -> Query:
    def q(spark, sf_dir):
        return UserFeatures(lineitem_log(spark, sf_dir), sequences=False).family(family)
    return q


def _user_sql_on(columns: list[str], source: str) -> str:
    return O.with_log(O.select_columns(columns, O.USER_DOUBLES, "u_final"), *O.ALL_USER_CTES, source=source)


for _fam in ("user_basic", "user_depth", "user_conversion", "user_time_activity"):
    register(f"scale_{_fam}", _user_sql_on(["user_id"] + FAMILIES[_fam], "lineitem"))(_scale_user(_fam))


def _scale_entity(key: str) -> Query:
    def q(spark, sf_dir):
        return EntityFeatures(lineitem_log(spark, sf_dir), key).table()
    return q


register("scale_item_feature_table",
         O.entity_sql("item_id", ENTITIES["item_id"]["columns"], source="lineitem"))(_scale_entity("item_id"))
register("scale_category_feature_table",
         O.entity_sql("item_category", ENTITIES["item_category"]["columns"], source="lineitem"))(
    _scale_entity("item_category"))


# ----- streaming: the cleaning job over arriving files -------------------------

from footfall.streaming import start_clean_stream  # noqa: E402


@register("clean_log_stream", X["clean_log"])
def clean_log_stream(spark, sf_dir):
    """The raw log written as CSV files into a landing folder, cleaned by the
    streaming job (available-now trigger) and read back from its sink."""
    landing = sinks.scratch_path(spark, "landing")
    sink = sinks.scratch_path(spark, "stream-sink")
    events_raw(spark, sf_dir).write.mode("overwrite").option("header", True).csv(landing)
    query = start_clean_stream(spark, landing, sink, checkpoint_location=sinks.scratch_path(spark, "stream-ckpt"))
    query.awaitTermination()
    return readers.read_log(spark, sink)
