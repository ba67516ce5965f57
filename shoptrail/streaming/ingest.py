"""Drain a topic into bronze and quarantine, exactly once per record and sink."""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from shoptrail.operators.validity import accepted, judge, rejected
from shoptrail.sources.batches import BatchLog, folder_of
from shoptrail.sources.layers import drop_path, write_layer


@dataclass
class BronzeSink:
    """Routes one micro-batch to both sinks.

    A batch goes to a folder named after the query and the batch, and that folder is overwritten.
    A batch that is replayed after a failure therefore replaces its first attempt instead of adding
    to it. The query id lives in the checkpoint: it outlasts restarts and changes on a reset, so
    batch numbers that start over do not collide with older ones.

    A folder counts once the sink's log has an entry for it (see ``batches``). Under ``touched_path`` the days of each batch are noted before its rows are written, so that a later
    build knows what to bring up to date, also after a failure in between.
    """

    bronze_path: str
    quarantine_path: str
    ingested_at: Column | None = None
    run_id: str | None = None
    touched_path: str | None = None
    rows: dict[str, int] = field(default_factory=lambda: {"accepted": 0, "rejected": 0})
    _named: threading.Event = field(default_factory=threading.Event)

    def name_run(self, run_id: str) -> None:
        self.run_id = run_id
        self._named.set()

    def _folder(self, root: str, batch_id: int) -> str:
        return f"{root.rstrip('/')}/{folder_of(self.run_id, batch_id)}"

    def __call__(self, records: DataFrame, batch_id: int) -> None:
        self._named.wait()
        # Both sinks and the counts read the parsed batch; its size is set by the source's limit.
        batch = judge(records, self.ingested_at).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fine = F.col("invalid_reason").isNull()
            counts = batch.agg(F.count_if(fine).alias("a"), F.count_if(~fine).alias("r")).first()
            if counts["a"]:
                if self.touched_path:
                    days = accepted(batch).select("event_date").distinct()
                    write_layer(days, self._folder(self.touched_path, batch_id))
                folder = self._folder(self.bronze_path, batch_id)
                write_layer(accepted(batch), folder, ("event_date", "event_type"))
                BatchLog(records.sparkSession, self.bronze_path).commit(self.run_id, batch_id)
            if counts["r"]:
                write_layer(rejected(batch), self._folder(self.quarantine_path, batch_id))
                BatchLog(records.sparkSession, self.quarantine_path).commit(self.run_id, batch_id)
            self.rows["accepted"] += counts["a"]
            self.rows["rejected"] += counts["r"]
        finally:
            batch.unpersist()


def drain(
    records: DataFrame,
    sink: BronzeSink,
    checkpoint: str,
    query_name: str = "topic_to_bronze",
    reset: bool = False,
    clear_outputs: bool = False,
) -> dict[str, int]:
    """Process everything the source has now, then stop; a later call takes only what is new.

    ``reset`` forgets the checkpoint, so the source is read from its start again and lands beside
    what earlier runs wrote; ``clear_outputs`` also empties both sinks first.
    """
    spark = records.sparkSession
    if clear_outputs and not reset:
        raise ValueError("clearing the outputs needs a reset, or their records would not come back")
    if reset:
        drop_path(spark, checkpoint)
    if clear_outputs:
        for path in (sink.bronze_path, sink.quarantine_path):
            BatchLog(spark, path).forget()
            drop_path(spark, path)
    query = (
        records.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .queryName(query_name)
        .trigger(availableNow=True)
        .start()
    )
    sink.name_run(str(query.id))
    query.awaitTermination()
    return dict(sink.rows)
