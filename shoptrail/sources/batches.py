"""Log of the batches that a sink has committed, and their compaction.

A stream writes a folder per micro-batch. An entry in the log says that a batch's folder is whole; readers take the folders
of the log. Compaction folds committed batches into one folder laid out by date and type and commits it with a single
entry that names what it replaces. Until that entry stands, readers see the batches, from then on the new folder, so a
crash at any point neither loses nor repeats a row; what a crash leaves behind is removed by the next compaction.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from shoptrail.sources.layers import drop_path, file_names, path_exists, write_layer

#: Stands in the place of a query's name in folders that compaction has made.
COMPACTED = "compacted"
_ENTRY = "folder string, replaces array<string>"


class BatchLog:
    """Log at ``{sink}_log`` beside the sink's folder."""

    def __init__(self, spark: SparkSession, sink: str):
        self.spark, self.sink = spark, sink.rstrip("/")
        self.path = f"{self.sink}_log"

    def _put(self, name: str, folder: str, replaces: list[str]) -> None:
        """An entry appears whole or not at all: it is written under another name first."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        done, half = path(f"{self.path}/{name}.json"), path(f"{self.path}/.{name}-{uuid.uuid4().hex}")
        system = done.getFileSystem(self.spark._jsc.hadoopConfiguration())
        out = system.create(half, True)
        out.write(bytearray(json.dumps({"folder": folder, "replaces": replaces}).encode()))
        out.close()
        if system.exists(done):  # a replayed batch: the entry says the same
            system.delete(half, False)
        elif not system.rename(half, done):
            raise OSError(f"could not commit {name} to {self.path}")

    def commit(self, run: str, batch: int) -> None:
        """Note that a batch's folder is whole; a replayed batch notes it again. The first entry of a log takes in the
        folders that were there before there was a log."""
        if not path_exists(self.spark, self.path):
            for older in sorted(file_names(self.spark, self.sink)):
                for name in sorted(file_names(self.spark, f"{self.sink}/{older}") if older.startswith("ingest_run=") else ()):
                    self._put(_entry(f"{older}/{name}"), f"{older}/{name}", [])
        self._put(_entry(folder_of(run, batch)), folder_of(run, batch), [])

    def _entries(self) -> list[tuple[str, list[str]]] | None:
        """A row per batch since the last compaction and per compaction: steps of the log, not data."""
        if not path_exists(self.spark, self.path):
            return None
        rows = self.spark.read.schema(_ENTRY).json(self.path).collect()
        return [(row["folder"], list(row["replaces"])) for row in rows]

    def folders(self) -> list[str] | None:
        """Folders that hold the committed rows; None without a log."""
        entries = self._entries()
        if entries is None:
            return None
        return sorted({folder for folder, _ in entries} - {folder for _, replaces in entries for folder in replaces})

    def compact(self, schema, partition: tuple[str, ...]) -> dict[str, int]:
        """Fold all committed folders into one; returns how many folders there were before and after."""
        self.clean()
        before = self.folders() or []
        if len(before) < 2:
            return {"before": len(before), "after": len(before)}
        replaced = [folder for _, replaces in self._entries() for folder in replaces]
        folded = folder_of(COMPACTED, 1 + max((_number(f) for f in [*before, *replaced] if _run(f) == COMPACTED), default=0))
        write_layer(read_folders(self.spark, self.sink, before, schema), f"{self.sink}/{folded}", partition or None)
        # A stream may replay its last batch, so the last one of each run stays named for good.
        last = {_run(f): f for f in sorted([*before, *replaced], key=_number)}
        self._put(_entry(folded), folded, sorted({*before, *last.values()} - {folded}))
        self.clean()
        return {"before": len(before), "after": 1}

    def clean(self) -> None:
        """Remove what a compaction has replaced, and folders of compactions that were never committed."""
        entries = self._entries()
        if entries is None:
            return
        replaced = {folder for _, replaces in entries for folder in replaces}
        for folder in replaced:
            drop_path(self.spark, f"{self.sink}/{folder}")
            drop_path(self.spark, f"{self.path}/{_entry(folder)}.json")
        committed = {folder for folder, _ in entries}
        for name in file_names(self.spark, f"{self.sink}/ingest_run={COMPACTED}"):
            if f"ingest_run={COMPACTED}/{name}" not in committed:
                drop_path(self.spark, f"{self.sink}/ingest_run={COMPACTED}/{name}")

    def forget(self) -> None:
        drop_path(self.spark, self.path)


def folder_of(run: str, batch: int) -> str:
    return f"ingest_run={run}/batch_id={batch}"


def _run(folder: str) -> str:
    return folder.split("/")[0].removeprefix("ingest_run=")


def _number(folder: str) -> int:
    return int(folder.rsplit("=", 1)[1])


def _entry(folder: str) -> str:
    return f"batch-{_run(folder)}-{_number(folder)}"


def read_folders(spark: SparkSession, sink: str, folders: list[str], schema) -> DataFrame:
    """Rows of some folders of a sink, by the declared schema."""
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", sink).parquet(*[f"{sink}/{folder}" for folder in folders])
    return rows.select(*schema.names)


def read_sink(spark: SparkSession, sink: str, schema) -> DataFrame:
    """Committed rows of a sink; all of its folder where it has no log."""
    folders = BatchLog(spark, sink).folders()
    if folders is None:
        return spark.read.schema(schema).parquet(sink).select(*schema.names)
    return read_folders(spark, sink.rstrip("/"), folders, schema)
