"""Event topics: encode rows as keyed JSON, write them, and read them as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoptrail import schemas as S

# Texts that count as a whole number and as a decimal number.
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"
DECIMAL_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# Most records taken into one micro-batch, which is cached while it is routed (some 50 GB).
RECORDS_PER_BATCH = 100_000_000

_NUMBERS = {
    "product_id": ("bigint", WHOLE_NUMBER),
    "category_id": ("bigint", WHOLE_NUMBER),
    "user_id": ("bigint", WHOLE_NUMBER),
    "price": ("double", DECIMAL_NUMBER),
}


def _number_or_text(name: str) -> Column:
    """The number a text spells, else the text as it is; either way one JSON value."""
    kind, pattern = _NUMBERS[name]
    text = F.col(name)
    number = F.when(text.rlike(pattern), text.try_cast(kind))
    return F.coalesce(number.cast("variant"), text.cast("variant"))


def encode(rows: DataFrame, position: Column) -> DataFrame:
    """All-text rows to (key, value).

    Empty text becomes null, and number columns become JSON numbers where they spell one. The key
    is the event id; a row without one is keyed by its ``position`` in the source.
    """
    texts = rows.select(
        position.alias("_position"),
        *[F.nullif(F.col(name), F.lit("")).alias(name) for name in S.PAYLOAD.names],
    )
    fields = [
        (_number_or_text(name) if name in _NUMBERS else F.col(name)).alias(name)
        for name in S.PAYLOAD.names
    ]
    return texts.select(
        F.coalesce("event_id", F.concat(F.lit("row_"), F.col("_position").cast("string"))).alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_kafka(records: DataFrame, servers: str, topic: str) -> None:
    """Publish (key, value) rows; Spark retries failed tasks, the broker confirms every replica."""
    records.select("key", "value").write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "kafka.acks": "all", "topic": topic}
    ).save()


def write_files(records: DataFrame, path: str, topic: str, partitions: int) -> None:
    """Publish to a folder of envelope files that ``read_files`` streams, where there is no broker.

    A record's partition follows from its key. Offsets rise within a file and never repeat.
    """
    envelope = records.select(
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("key"), F.lit(partitions)).alias("partition"),
        F.monotonically_increasing_id().alias("offset"),
        F.current_timestamp().alias("timestamp"),
        "key",
        "value",
    )
    envelope.write.mode("append").parquet(path)


def read_kafka(
    spark: SparkSession, servers: str, topic: str, start: str = "earliest",
    records_per_batch: int | None = RECORDS_PER_BATCH,
) -> DataFrame:
    """Stream a topic from ``earliest`` or ``latest`` where no checkpoint says otherwise.

    A backlog bigger than ``records_per_batch`` is drained in several batches.
    """
    if start not in ("earliest", "latest"):
        raise ValueError("start must be 'earliest' or 'latest'")
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": "false",
    }
    if records_per_batch:
        options["maxOffsetsPerTrigger"] = str(records_per_batch)
    return spark.readStream.format("kafka").options(**options).load()


def read_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream a folder of envelope files; new files are new records."""
    reader = spark.readStream.schema(S.ENVELOPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
