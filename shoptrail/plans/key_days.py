"""Which days a key occurs on: a persisted index, so that an update reads only days that can matter.

An index holds a day's distinct keys as sorted 64-bit digests, one folder per day. It answers "which other days share a key
with these?" from eight bytes a key, without opening the layer itself; two keys with one digest only add a day that
needn't be read. A day's folder is replaced when its rows have changed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoptrail.sources.layers import drop_path, path_exists, replace_days

Days = list[dt.date]
_ROW = "digest bigint, day date"


@dataclass(frozen=True)
class KeyDays:
    """An index of (key, day) at ``path``."""

    path: str

    def known(self, spark: SparkSession) -> bool:
        return path_exists(spark, f"{self.path}/_SUCCESS")

    def forget(self, spark: SparkSession) -> None:
        drop_path(spark, self.path)

    def build(self, rows: DataFrame) -> None:
        """Index all rows (key, day)."""
        _digests(rows).write.mode("overwrite").partitionBy("day").parquet(self.path)

    def note(self, rows: DataFrame, days: Days) -> None:
        """Replace some days by what ``rows`` (key, day) has of them."""
        replace_days(_digests(rows), self.path, "day", days)

    def others(self, keys: DataFrame, days: Iterable[dt.date]) -> Days:
        """Days besides ``days`` on which one of the keys (one column) occurs."""
        spark = keys.sparkSession
        wanted = keys.select(_digest(keys.columns[0])).where("digest is not null").distinct()
        # Folders of the given days are pruned; of the others one column is read.
        rest = spark.read.schema(_ROW).parquet(self.path).where(~F.col("day").isin(list(days)))
        found = rest.join(wanted, "digest", "left_semi").select("day").distinct().collect()  # a row per day
        return sorted(row["day"] for row in found)


def _digest(key: str):
    return F.when(F.col(key).isNotNull(), F.xxhash64(key)).alias("digest")


def _digests(rows: DataFrame) -> DataFrame:
    named = rows.select(_digest("key"), "day").where("digest is not null and day is not null").distinct()
    return named.repartition("day").sortWithinPartitions("day", "digest")
