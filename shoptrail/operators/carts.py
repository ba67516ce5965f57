"""Cart activity per session and the abandoned-cart fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoptrail import schemas as S
from shoptrail.functions.columns import stamp


def cart_details(session_events: DataFrame) -> DataFrame:
    """Cart events per session, by way of one row per (session, product)."""
    per_product = (
        session_events.where("event_type = 'cart'")
        .groupBy("session_id", "product_id")
        .agg(
            F.min("event_ts").alias("first_ts"),
            F.max("event_ts").alias("last_ts"),
            F.count("*").alias("rows"),
        )
    )
    return per_product.groupBy("session_id").agg(
        F.min("first_ts").alias("first_cart_ts"),
        F.max("last_ts").alias("last_cart_ts"),
        F.count("product_id").alias("distinct_products_carted"),
        F.sum("rows").alias("cart_event_count"),
    )


def abandoned(session_facts: DataFrame) -> DataFrame:
    """Sessions that put something in a cart and bought nothing."""
    return session_facts.where((F.col("cart_count") > 0) & ~F.col("converted"))


def cart_abandonment(
    session_facts: DataFrame, details: DataFrame, processed_at: Column | None = None
) -> DataFrame:
    """Abandoned sessions with their cart details.

    Both sides are at most one row per session and user, and the details one per session; AQE
    decides between broadcast and sort-merge and splits a session id shared by many users.
    """
    joined = abandoned(session_facts).join(details, "session_id", "left")
    return joined.withColumns(
        {
            "cart_event_count": F.coalesce("cart_event_count", "cart_count"),
            "abandoned": F.lit(True),
            "gold_processed_at": stamp(processed_at),
        }
    ).select(*S.FCT_CART_ABANDONMENT.names)
