"""Column expressions used by more than one operator. All are built-in, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shoptrail.schemas import EVENT_TIME_FORMAT, EVENT_TIME_SUFFIX, EVENT_TYPES


def trimmed_or_null(text: Column) -> Column:
    """Text without surrounding spaces; NULL when nothing is left."""
    return F.nullif(F.trim(text), F.lit(""))


def is_filled(text: Column) -> Column:
    """True when text holds something other than spaces; never NULL."""
    return trimmed_or_null(text).isNotNull()


def is_blank(text: Column) -> Column:
    """True for NULL or nothing but white space of any kind; never NULL."""
    return text.isNull() | text.rlike(r"^\s*$")


def is_known_type(event_type: Column) -> Column:
    return F.coalesce(event_type.isin(*EVENT_TYPES), F.lit(False))


def parse_event_time(text: Column) -> Column:
    """``2019-10-01 00:00:00 UTC`` (suffix optional) as a timestamp; NULL when it is not one."""
    bare = F.regexp_replace(text, f"{EVENT_TIME_SUFFIX}$", "")
    return F.try_to_timestamp(bare, F.lit(EVENT_TIME_FORMAT))


def seconds_between(start: Column, end: Column) -> Column:
    """Difference in whole seconds, each end cut to its second first."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def capped_ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, at most 1, and 0 when there is no whole."""
    return F.when(whole > 0, F.least(F.lit(1.0), part / whole)).otherwise(F.lit(0.0))


def events_of(event_type: str) -> Column:
    """Aggregate: how many rows are events of this type."""
    return F.count_if(F.col("event_type") == event_type)


def purchase_value(price: str = "price") -> Column:
    """What a row adds to revenue: its price when it is a purchase that has one, else 0."""
    sold = F.coalesce(F.col(price), F.lit(0.0))
    return F.when(F.col("event_type") == "purchase", sold).otherwise(F.lit(0.0))


def stamp(at: Column | None) -> Column:
    """Audit clock: the given time, or the time the query runs."""
    return F.current_timestamp() if at is None else at
