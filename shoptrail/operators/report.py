"""Small reports over layers and marts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shoptrail import schemas as S


def event_type_histogram(events: DataFrame) -> DataFrame:
    """Rows per event type in alphabetical order; NULL is a bar of its own."""
    kind = F.coalesce("event_type", F.lit("NULL")).alias("event_type")
    return events.groupBy(kind).agg(F.count("*").alias("row_count")).orderBy("event_type")


def totals(df: DataFrame, amount: str, key: str) -> DataFrame:
    """One row: rows, sum of an amount (NULL adds nothing) and distinct values of a key.

    The key is counted by way of one row per value, so no task sees all values.
    """
    per_key = df.groupBy(key).agg(
        F.count("*").alias("n"), F.sum(F.coalesce(F.col(amount), F.lit(0.0))).alias("s")
    )
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("s"), F.lit(0.0)).alias("total"),
        F.count(key).alias("distinct_keys"),
    )


def session_kpis(mart_sessions: DataFrame) -> DataFrame:
    """Sessions, converted sessions, revenue, mean duration, and the conversion rate."""
    kpis = mart_sessions.agg(
        F.count("*").alias("session_count"),
        F.count_if("converted").alias("converted_sessions"),
        F.sum("session_revenue").alias("total_revenue"),
        F.avg("session_duration_seconds").alias("avg_duration_sec"),
    )
    share = F.try_divide("converted_sessions", "session_count")
    return kpis.withColumn("conversion_rate", F.coalesce(share, F.lit(0.0)))


def funnel_by_day(mart_conversion_funnel: DataFrame) -> DataFrame:
    columns = [c for c in S.MARTS["mart_conversion_funnel"][1] if c != "gold_processed_at"]
    return mart_conversion_funnel.select(*columns).orderBy("session_date")


def top_products(mart_product_performance: DataFrame, n: int = S.TOP_PRODUCTS) -> DataFrame:
    """Best sellers by revenue; the product id settles ties."""
    return (
        mart_product_performance.select(
            "product_id",
            "category_code",
            "brand",
            "purchase_count",
            "unique_purchasers",
            "total_revenue",
            "view_to_purchase_rate",
            "cart_to_purchase_rate",
        )
        .orderBy(F.desc_nulls_last("total_revenue"), "product_id")
        .limit(n)
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) in order of name."""
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted).orderBy("table_name")
