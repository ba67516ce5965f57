"""Frequent keys of a layer, noted while it is written and kept beside it.

A sketch of frequent items rides along with the write, so nobody has to read a layer to learn which of its keys are too
big for one task. Notes say how often a key occurred in one write; a key's notes are added up. Notes of rows that a later
write replaced stay, so sums may be too high, never too low by more than the sketch's own error: they only steer plans.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from shoptrail.operators.skew import HEAVY_GROUP_ROWS, heavy_keys
from shoptrail.sources.layers import drop_path, path_exists

#: Keys that a sketch tracks and gives back. Every task sends its sketch to the driver, some 0.1 MB with so many keys. It errs
#: by at most 3.5 rows in TRACKED of those written, so a key of ``HEAVY_GROUP_ROWS`` is not missed in a write of less than
#: some 2 * 10^10 rows; a missed one is sorted by one task, which spills, with the same result.
TRACKED, GIVEN = 1 << 12, 1 << 10
#: Share of a heavy group from which on a key is noted: one that grows by small writes is found all the same.
NOTED_SHARE = 64
_NOTE = "key string, n bigint"


class KeySketch:
    """Sketch of one column of the rows that pass.

    >>> seen = KeySketch("silver", "user_session"); write(seen.watch(rows)); seen.keep(path)
    """

    def __init__(self, name: str, key: str, rows: int = HEAVY_GROUP_ROWS):
        self._observation, self._key, self._least = Observation(name), key, max(1, rows // NOTED_SHARE)

    def watch(self, df: DataFrame) -> DataFrame:
        self._spark = df.sparkSession
        top = F.expr(f"approx_top_k(CAST(`{self._key}` AS STRING), {GIVEN}, {TRACKED})")
        return df.observe(self._observation, top.alias("top"))

    def keep(self, path: str, replace: bool) -> None:
        """Note the frequent keys beside the layer at ``path``; ``replace`` when all of it was written."""
        try:
            top = self._observation.get["top"] or []
        except Py4JJavaError as error:  # an empty result has no metrics
            if "AssertionError" not in str(error):
                raise
            top = []
        rows = [(item["item"], item["count"]) for item in top if item["item"] is not None and item["count"] >= self._least]
        notes = self._spark.createDataFrame(rows, _NOTE).coalesce(1)
        notes.write.mode("overwrite" if replace else "append").parquet(_notes(path))


def _notes(path: str) -> str:
    """Spark's scans leave out names that begin with an underscore."""
    return f"{path.rstrip('/')}/_frequent_keys"


def drop_notes(spark: SparkSession, path: str) -> None:
    drop_path(spark, _notes(path))


def frequent_keys(spark: SparkSession, path: str, layer: DataFrame, key: str, rows: int = HEAVY_GROUP_ROWS) -> list[str]:
    """Keys with some ``rows`` rows or more, from the notes; a layer without notes is counted."""
    if not path_exists(spark, _notes(path)):
        return heavy_keys(layer, key, rows)
    notes = spark.read.schema(_NOTE).parquet(_notes(path))
    found = notes.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= rows)
    return [row["key"] for row in found.orderBy(F.desc("n"), "key").collect()]
