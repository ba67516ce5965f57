"""Derive shop events and topic records from the generic ``events`` test table.

The test table has no sessions, products or carts, so ids and the text in ``props`` are mapped to
them. Residues of the id plant the faults the pipeline must handle; every tenth record is delivered
twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from shoptrail import schemas as S

TOPIC = "shop_events"
PARTITIONS = 4
REDELIVERY_OFFSET = 1_000_000

EVENTS = StructType(
    [
        StructField("event_id", LongType()),
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
        StructField("props", StringType()),
    ]
)


def _every(step: int) -> Column:
    return F.col("event_id") % step == 0


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, **options: str) -> DataFrame:
    reader = spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet")
    return reader.options(**options).parquet(sf_dir)


def _columns() -> dict[str, Column]:
    n, k = F.col("event_id"), F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")

    def residue(step: int) -> Column:
        return (k % step).cast("string")

    return {
        "event_id": F.when(_every(97), None)
        .when(_every(101), "")
        .otherwise(F.concat(F.lit("evt_42_"), F.lpad((n + 1).cast("string"), 10, "0"))),
        "event_time": F.when(_every(89), None)
        .when(_every(83), "not-a-time")
        .otherwise(F.concat(F.date_format("ts", S.EVENT_TIME_FORMAT), F.lit(S.EVENT_TIME_SUFFIX))),
        "event_type": F.when(_every(79), None)
        .when(F.col("event_type") == "click", "cart")
        .when(F.col("event_type") == "signup", "remove_from_cart")
        .otherwise(F.col("event_type")),
        "product_id": F.when(~_every(73), k),
        "category_id": F.when(k % 11 == 0, "n/a").otherwise(
            (F.lit(2053013555631882000) + k % 10).cast("string")
        ),
        "category_code": F.when(k % 7 == 0, "  ")
        .when(k % 5 == 0, None)
        .otherwise(F.concat(F.lit(" cat."), residue(10))),
        "brand": F.when(k % 13 == 0, "")
        .when(_every(3), F.concat(F.lit(" Brand"), residue(17), F.lit(" ")))
        .otherwise(F.concat(F.lit("brand"), residue(17))),
        "price": F.when(_every(71), None).when(_every(67), -F.col("value")).otherwise(F.col("value")),
        "user_id": F.when(~_every(61), F.col("user_id")),
        "user_session": F.when(_every(59), " ").otherwise(
            F.concat_ws("_", F.lit("s"), F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd"))
        ),
    }


def deliveries(events: DataFrame) -> DataFrame:
    """Payload columns plus the envelope position; ``source_row`` counts deliveries from 0.

    A test table may be one row group, which one task would encode and parse; a topic's partitions are many.
    """
    events = events.repartition("event_id")
    copies = F.when(_every(10), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    delivered = events.withColumn("copy", F.explode(copies))
    n = F.col("event_id")
    return delivered.select(
        *[expr.alias(name) for name, expr in _columns().items()],
        F.lit(TOPIC).alias("topic"),
        (n % PARTITIONS).cast("int").alias("partition"),
        (F.floor(n / PARTITIONS).cast("bigint") + F.col("copy") * REDELIVERY_OFFSET).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (n * 2 + F.col("copy")).alias("source_row"),
    )


def sample_rows(events: DataFrame) -> DataFrame:
    """The deliveries as a text file would hold them: every payload column is text."""
    rows = deliveries(events)
    return rows.select("source_row", *[F.col(c).cast("string").alias(c) for c in S.PAYLOAD.names])


def topic_records(events: DataFrame) -> DataFrame:
    """The deliveries as topic records: JSON value in its envelope."""
    rows = deliveries(events)
    document = F.to_json(F.struct(*S.PAYLOAD.names), {"ignoreNullFields": "false"})
    return rows.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("event_id").alias("key"),
        document.alias("value"),
    )
