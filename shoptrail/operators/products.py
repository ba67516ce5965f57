"""Product performance: one row per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoptrail import schemas as S
from shoptrail.functions.columns import capped_ratio, events_of, purchase_value, stamp

_COUNTS = {f"{kind}_count": kind for kind in S.EVENT_TYPES}
_UNIQUES = {
    "unique_viewers": "view_count",
    "unique_cart_adders": "cart_count",
    "unique_purchasers": "purchase_count",
}
_ATTRIBUTES = ("category_id", "category_code", "brand")


#: State that merges: one row per (day, product, user), and one per (day, product).
USER_STATE = (
    "product_id bigint, user_id bigint, " + ", ".join(f"{name} bigint" for name in _COUNTS) + ", revenue double, event_date date"
)
ATTRIBUTE_STATE = "product_id bigint, category_id bigint, category_code string, brand string, event_date date"


#: Names a product in groups and joins: events without a product are a group of their own, and keys without NULL let both
#: sides of the join keep the partitions they were grouped by.
_KEY = ("_product", "_known")


def _keyed(rows: DataFrame) -> DataFrame:
    known = F.col("product_id").isNotNull()
    return rows.withColumns({"_product": F.coalesce("product_id", F.lit(0).cast("bigint")), "_known": known}).drop("product_id")


def _product_id() -> Column:
    return F.when(F.col("_known"), F.col("_product")).alias("product_id")


def _per_user(events: DataFrame, *keys: str) -> DataFrame:
    return _keyed(events).groupBy(*keys, *_KEY, "user_id").agg(
        *[events_of(kind).alias(name) for name, kind in _COUNTS.items()],
        F.sum(purchase_value()).alias("revenue"),
        F.max("event_date").alias("last_date"),
    )


def _measures(per_user: DataFrame) -> DataFrame:
    """Counts, revenue and unique users per product, from one row per (product, user)."""
    known = F.col("user_id").isNotNull()
    return per_user.groupBy(*_KEY).agg(
        *[F.sum(name).alias(name) for name in _COUNTS],
        *[F.count_if(known & (F.col(of) > 0)).alias(name) for name, of in _UNIQUES.items()],
        F.sum("revenue").alias("total_revenue"),
        F.max("last_date").alias("last_event_date"),
    )


def _attributes(events: DataFrame, *keys: str) -> DataFrame:
    """The greatest value of each attribute per product, each on its own.

    Keeping the greatest text in a buffer needs a sort; grouping by text does not. So the events
    are first brought down to their few combinations. Catalyst would fold a plain ``distinct`` into
    the outer maximum; the count and its filter keep the levels apart.
    """
    combinations = (
        _keyed(events).groupBy(*keys, *_KEY, *_ATTRIBUTES).agg(F.count("*").alias("n")).where("n > 0")
    )
    return combinations.groupBy(*keys, *_KEY).agg(*[F.max(name).alias(name) for name in _ATTRIBUTES])


def by_day_and_user(events: DataFrame) -> DataFrame:
    """What events say of measures, by day: rows that add up over days."""
    return _per_user(events, "event_date").select(_product_id(), "user_id", *_COUNTS, "revenue", "event_date")


def attributes_by_day(events: DataFrame) -> DataFrame:
    return _attributes(events, "event_date").select(_product_id(), *_ATTRIBUTES, "event_date")


def from_state(users: DataFrame, attributes: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Product performance from the rows of ``by_day_and_user`` and ``attributes_by_day``."""
    per_user = _keyed(users).groupBy(*_KEY, "user_id").agg(
        *[F.sum(name).alias(name) for name in _COUNTS], F.sum("revenue").alias("revenue"), F.max("event_date").alias("last_date")
    )
    greatest = _keyed(attributes).groupBy(*_KEY).agg(*[F.max(name).alias(name) for name in _ATTRIBUTES])
    return _finished(_measures(per_user), greatest, processed_at)


def product_performance(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Summarise session (or silver) events per product.

    Measures and text attributes are taken apart so that the (product, user) shuffle carries only
    numbers; they meet again at one row per product.
    """
    return _finished(_measures(_per_user(events)), _attributes(events), processed_at)


def _finished(measures: DataFrame, attributes: DataFrame, processed_at: Column | None) -> DataFrame:
    products = measures.join(attributes, list(_KEY))
    sold = F.col("purchase_count")
    return products.withColumns(
        {
            "product_id": _product_id(),
            "view_to_purchase_rate": capped_ratio(sold, F.col("view_count")),
            "cart_to_purchase_rate": capped_ratio(sold, F.col("cart_count")),
            "gold_processed_at": stamp(processed_at),
        }
    ).select(*S.AGG_PRODUCT_PERFORMANCE.names)
