"""Bronze to silver: clean, keep what is usable, keep one row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoptrail.functions.columns import (
    is_filled,
    is_known_type,
    parse_event_time,
    stamp,
    trimmed_or_null,
)


def usable() -> Column:
    """Rows that may enter silver. Cleaning does not touch any column used here but the time."""
    present = [F.col(c).isNotNull() for c in ("event_ts", "event_date", "product_id", "user_id")]
    rules = [
        is_filled(F.col("event_id")),
        is_filled(F.col("user_session")),
        is_known_type(F.col("event_type")),
        *present,
        F.col("price").isNull() | (F.col("price") >= 0),
    ]
    verdict = rules[0]
    for rule in rules[1:]:
        verdict = verdict & rule
    return verdict


def latest_delivery(events: DataFrame) -> DataFrame:
    """One row per event_id: highest topic partition, then offset, then ingest time.

    The rank filter becomes a group limit on both sides of the shuffle, so each task sends at most
    one row per id and an id delivered billions of times does not pile up in one place. The row
    digest settles full ties, so that a recomputed task picks the same row again.
    """
    newest_first = [
        F.col(c).desc_nulls_last() for c in ("kafka_partition", "kafka_offset", "ingested_at")
    ]
    digest = F.xxhash64(*[c for c in events.columns if c != "event_id"])
    ranking = Window.partitionBy("event_id").orderBy(*newest_first, digest)
    return events.withColumn("_rank", F.row_number().over(ranking)).where("_rank = 1").drop("_rank")


def to_silver(bronze: DataFrame, processed_at: Column | None = None) -> DataFrame:
    timed = bronze.withColumn("event_ts", parse_event_time(F.col("event_time")))
    cleaned = timed.where(usable()).select(
        "event_id",
        "event_ts",
        "event_date",
        "event_type",
        "product_id",
        F.col("category_id").try_cast("bigint").alias("category_id"),
        trimmed_or_null(F.col("category_code")).alias("category_code"),
        F.lower(trimmed_or_null(F.col("brand"))).alias("brand"),
        "price",
        "user_id",
        "user_session",
        "kafka_partition",
        "kafka_offset",
        "ingested_at",
    )
    return (
        latest_delivery(cleaned)
        .withColumnRenamed("ingested_at", "bronze_ingested_at")
        .drop("kafka_partition", "kafka_offset")
        .withColumn("silver_processed_at", stamp(processed_at))
    )
