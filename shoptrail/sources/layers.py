"""Parquet layers: declared scans, laid-out writes, and counts taken on the way."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class RunMetrics:
    rows_read: int
    rows_written: int

    @property
    def rows_dropped(self) -> int:
        return self.rows_read - self.rows_written


def read_layer(
    spark: SparkSession, path: str, schema: StructType, since: str | None = None,
    until: str | None = None, date_column: str | None = None,
) -> DataFrame:
    """Scan a layer by its declared schema; a date range prunes partitions before listing files."""
    layer = spark.read.schema(schema).parquet(path).select(*schema.names)
    if since is not None:
        layer = layer.where(F.col(date_column) >= F.lit(since).cast("date"))
    if until is not None:
        layer = layer.where(F.col(date_column) <= F.lit(until).cast("date"))
    return layer


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Scan what is really there (schema from the files), for checks; complain when nothing is."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise FileNotFoundError(f"no Parquet files at {path}") from error
        raise


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder on whatever file system it lives; False when there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(system.delete(target, True))


def file_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files of one partition folder; none if it is not there."""
    if not path_exists(spark, folder):
        return set()
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in system.listStatus(target)}


def require_rows(df: DataFrame, what: str) -> int:
    """Number of rows of a layer, which must have some. For Parquet this reads footers only."""
    rows = df.count()
    if not rows:
        raise ValueError(f"no rows in {what}")
    return rows


def write_layer(
    df: DataFrame, path: str, partition: str | Sequence[str] | None = None, mode: str = "overwrite",
    only_touched_partitions: bool = False,
) -> None:
    """Write one layer.

    With partition columns the rows are rebalanced by them first: AQE merges small partitions into
    a task and splits a big one over many, so files come out at a healthy size either way.
    ``only_touched_partitions`` makes overwrite replace just the partitions present in ``df``.
    """
    columns = [partition] if isinstance(partition, str) else list(partition or ())
    writer = (df.hint("rebalance", *columns) if columns else df).write.mode(mode)
    if columns:
        writer = writer.partitionBy(*columns)
    if only_touched_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def replace_days(df: DataFrame, path: str, column: str, days: list) -> None:
    """Write the given days of a table; days that have no rows any more are removed from it."""
    spark = df.sparkSession
    folders = {day: f"{path}/{column}={day}" for day in days}
    before = {day: file_names(spark, folder) for day, folder in folders.items()}
    write_layer(df.where(F.col(column).isin(list(days))), path, column, only_touched_partitions=True)
    for day, names in before.items():
        if names and file_names(spark, folders[day]) & names:
            drop_path(spark, folders[day])


class Counted:
    """Count rows as they pass, without a job of its own.

    >>> seen = Counted("bronze"); layer = seen.watch(layer); ...write...; seen.rows
    """

    def __init__(self, name: str):
        self._observation = Observation(name)

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._observation, F.count(F.lit(1)).alias("rows"))

    @property
    def rows(self) -> int:
        try:
            return self._observation.get["rows"]
        except Py4JJavaError as error:
            if "AssertionError" not in str(error):
                raise
            # Adaptive execution drops the counter along with everything else once it finds that
            # a result is empty; there is no metric to convert then.
            return 0
