"""Scalar column expressions.

Conventions (ANSI mode stays on):

* an undefined ratio is NULL, never NaN or an error;
* a flag is never NULL: a comparison against an undefined value is False;
* rounding is half-to-even on ``x * 10**d`` (``rint``), the way the reference
  rounds its float columns; Spark's ``round``/``bround`` differ on some inputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.schemas import BEHAVIOR_CODES, MISSING_TOKENS

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` as DOUBLE, NULL when the denominator is not positive."""
    if isinstance(num, str) and isinstance(den, str):
        # Same expression as SQL text: one call instead of a chain of small ones.
        return F.expr(f"CASE WHEN `{den}` > 0 THEN CAST(`{num}` AS DOUBLE) / CAST(`{den}` AS DOUBLE) END")
    n, d = _col(num), _col(den)
    return F.when(d > 0, n.cast("double") / d.cast("double"))


def round_half_even(c: ColumnOrName, digits: int = 4) -> Column:
    """Round like ``numpy.round``: ``rint(x * 10**d) / 10**d``."""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def flag(cond: Column) -> Column:
    """A boolean that is False wherever the condition is undefined."""
    return F.coalesce(cond, F.lit(False))


def behavior_name(code: ColumnOrName) -> Column:
    """Map a behaviour code to its name; unknown codes give NULL."""
    c = _col(code)
    out = None
    for value, name in BEHAVIOR_CODES.items():
        out = F.when(c == value, F.lit(name)) if out is None else out.when(c == value, F.lit(name))
    return out


def slot(hour: ColumnOrName, width: int) -> Column:
    """Index of the ``width``-hour slot that contains ``hour`` (``hour div width``)."""
    return F.floor(_col(hour) / F.lit(width)).cast("int")


def bit_flag(value: ColumnOrName) -> Column:
    """``1 << value`` as BIGINT; ``bit_count(bit_or(bit_flag(v)))`` counts the
    distinct small non-negative values of ``v`` without a distinct aggregate."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), _col(value).cast("int"))


def top_key(key: ColumnOrName, cnt: ColumnOrName) -> Column:
    """Aggregate: the key with the highest count, the smallest key on ties.

    ``min_by`` over ``(-cnt, key)`` is a plain hash aggregate with a partial
    (map-side) step, so it needs no sort and no per-key window.
    """
    k = _col(key)
    return F.min_by(k, F.struct((-_col(cnt)).alias("neg_cnt"), k.alias("key")))


def hours_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Elapsed hours from ``start`` to ``end`` as DOUBLE."""
    return F.timestamp_diff("SECOND", _col(start), _col(end)).cast("double") / F.lit(3600.0)


def day_span(first: ColumnOrName, last: ColumnOrName) -> Column:
    """Inclusive number of calendar days from ``first`` to ``last``."""
    return (F.datediff(F.to_date(_col(last)), F.to_date(_col(first))) + 1).cast("bigint")


def missing_to_null(c: ColumnOrName) -> Column:
    """Turn the text tokens a CSV reader treats as missing into NULL."""
    col = _col(c)
    return F.when(col.isin(MISSING_TOKENS), F.lit(None).cast("string")).otherwise(col)


# Fixed value: accepted shape of a number.  A plain cast would also take type
# suffixes (``'2d'``).
NUMBER_PATTERN = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"


def coerce_behavior(c: ColumnOrName) -> Column:
    """Text to number, NULL when not numeric (``'1.0'`` gives 1.0)."""
    text = F.trim(_col(c))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


# Fixed value: accepted shape of an hour timestamp, ``YYYY-M-D H`` with one or
# two digits for month, day and hour (minutes are not allowed).
HOUR_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}$"
# First and last hour of a 64-bit nanosecond timestamp; others are missing.
FIRST_HOUR, LAST_HOUR = "1677-09-21 01:00:00", "2262-04-11 23:00:00"


def parsed_hour(c: ColumnOrName) -> Column:
    """``'YYYY-MM-DD HH'`` text to TIMESTAMP_NTZ of any year; NULL for other text."""
    col = _col(c)
    return F.when(col.rlike(HOUR_PATTERN), F.concat(col, F.lit(":00:00")).try_cast("timestamp_ntz"))


def hour_in_range(hour: ColumnOrName) -> Column:
    """``hour``, NULL outside the nanosecond range."""
    h = _col(hour)
    return F.when(h.between(*[F.lit(x).cast("timestamp_ntz") for x in (FIRST_HOUR, LAST_HOUR)]), h)


def coerce_hour(c: ColumnOrName) -> Column:
    """``'YYYY-MM-DD HH'`` text to TIMESTAMP_NTZ; anything else (hour 24,
    minutes, bad dates, years outside the nanosecond range) gives NULL."""
    return hour_in_range(parsed_hour(c))


def id_value(c: ColumnOrName) -> Column:
    """Integral text (``'12'``, ``'12.0'``) as BIGINT, NULL otherwise; the
    decimal parse only runs when the plain cast fails."""
    text = F.trim(_col(c))
    dec = text.try_cast("decimal(38,6)")
    return F.coalesce(text.try_cast("bigint"), F.when(dec == F.floor(dec), dec.cast("bigint")))


def checked_id(raw: ColumnOrName, value: ColumnOrName) -> Column:
    """``value`` (from :func:`id_value` of ``raw``), failing the job with an
    error for a present but non-numeric id instead of dropping the row."""
    r, v = _col(raw), _col(value)
    return F.when(r.isNotNull() & v.isNull(), F.raise_error(F.concat(F.lit("non-numeric id: "), r))).otherwise(v)
