"""Session facts: one row per (session, user)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoptrail import schemas as S
from shoptrail.functions.columns import events_of, purchase_value, seconds_between, stamp

_COUNTS = {f"{kind}_count": kind for kind in S.EVENT_TYPES}


def session_facts(silver: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Summarise silver events per (session, user).

    Counting distinct products two ways in one aggregate would multiply every row. Instead a first
    level groups by product as well, after which a product seen is a row whose count is positive.
    Both levels add up inside the task before they shuffle, so a session of any size is fine.
    """
    per_product = silver.groupBy("user_session", "user_id", "product_id").agg(
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
        F.count("*").alias("event_count"),
        *[events_of(kind).alias(name) for name, kind in _COUNTS.items()],
        F.sum(purchase_value()).alias("revenue"),
    )
    known = F.col("product_id").isNotNull()
    facts = per_product.groupBy(F.col("user_session").alias("session_id"), "user_id").agg(
        F.min("first_ts").alias("session_start_ts"),
        F.max("last_ts").alias("session_end_ts"),
        F.sum("event_count").alias("event_count"),
        *[F.sum(name).alias(name) for name in _COUNTS],
        F.count_if(known & (F.col("view_count") > 0)).alias("distinct_products_viewed"),
        F.count_if(known & (F.col("purchase_count") > 0)).alias("distinct_products_purchased"),
        F.sum("revenue").alias("session_revenue"),
    )
    start, end = F.col("session_start_ts"), F.col("session_end_ts")
    return facts.withColumns(
        {
            "session_date": F.to_date(start),
            "session_duration_seconds": seconds_between(start, end),
            "converted": F.col("purchase_count") > 0,
            "gold_processed_at": stamp(processed_at),
        }
    ).select(*S.FCT_SESSIONS.names)
