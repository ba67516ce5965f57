"""Purchase facts: one row per purchase event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoptrail import schemas as S
from shoptrail.functions.columns import stamp

_RENAMED = {
    "event_id": "purchase_id",
    "event_ts": "purchase_ts",
    "event_date": "purchase_date",
    "price": "purchase_amount",
}


def purchase_facts(session_events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    return (
        session_events.where("event_type = 'purchase'")
        .withColumnsRenamed(_RENAMED)
        .withColumn("gold_processed_at", stamp(processed_at))
        .select(*S.FCT_PURCHASES.names)
    )
