"""Topic records to typed events, and the split into accepted and rejected ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoptrail import schemas as S
from shoptrail.functions.columns import is_known_type, parse_event_time, stamp


def unpack(records: DataFrame) -> DataFrame:
    """Envelope rows to one flat row per record.

    A field whose JSON type does not fit becomes NULL on its own; a document that is not JSON
    leaves all fields NULL. ``raw_value`` keeps the text.

    The document goes through a generator rather than a projection: filters on its fields cannot be
    pushed below a generator, where each field they mention would parse the document once more.
    """
    text = F.col("value").cast("string")
    envelope = [
        F.col(name).alias(f"kafka_{name}") for name in ("topic", "partition", "offset", "timestamp")
    ]
    return records.select(
        *envelope, text.alias("raw_value"), F.inline(F.array(F.from_json(text, S.PAYLOAD)))
    )


def rejection_reason() -> Column:
    """First rule a record breaks, NULL when it is fine.

    A NULL type is neither in nor out of the known types, so it needs a rule of its own, or such
    records would satisfy neither side of the split and vanish.
    """
    kind = F.col("event_type")
    return (
        F.when(F.col("event_id").isNull(), S.MISSING_EVENT_ID)
        .when(F.col("event_time").isNull(), S.MISSING_EVENT_TIME)
        .when(kind.isNotNull() & ~is_known_type(kind), S.INVALID_EVENT_TYPE)
        .when(F.col("event_date").isNull(), S.UNPARSEABLE_EVENT_TIME)
        .when(kind.isNull(), S.MISSING_EVENT_TYPE)
    )


def judge(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Unpacked records with ``event_date``, ``ingested_at`` and ``invalid_reason``."""
    dated = unpack(records).withColumns(
        {
            "event_date": F.to_date(parse_event_time(F.col("event_time"))),
            "ingested_at": stamp(ingested_at),
        }
    )
    reasoned = dated.withColumn("invalid_reason", rejection_reason())
    # Only rejected records need their text again; dropping the rest halves a cached batch.
    return reasoned.withColumn("raw_value", F.when(F.col("invalid_reason").isNotNull(), F.col("raw_value")))


def accepted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("invalid_reason").isNull()).select(*S.BRONZE.names)


def rejected(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("invalid_reason").isNotNull()).select(*S.QUARANTINE.names)


def reason_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("invalid_reason").agg(F.count("*").alias("row_count"))
