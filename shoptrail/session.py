"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Values every operator relies on. They are runtime settings, so they can be applied to a session
# somebody else created. Partition counts are left to the cluster and to AQE.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (UTC, ANSI) and adaptive execution."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def start(app_name: str = "shoptrail", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or fetch) a session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def fit_shuffles(df: DataFrame, partition_bytes: int = 128 * 1024 * 1024) -> int:
    """Raise the number of shuffle partitions to what the input's size asks for; never lower it.

    AQE merges partitions that turn out small, so starting with many is cheap, while too few would
    each have to spill. Meant for a stored layer: estimates past a join say little. Returns the
    number in force.
    """
    spark = df.sparkSession
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    wanted = max(current, -(-(size or 0) // partition_bytes))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


@contextmanager
def sized_shuffles(*inputs: DataFrame) -> Iterator[None]:
    """Size shuffles for the largest of the inputs while a job runs, then restore the session's setting."""
    spark, name = inputs[0].sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        for df in inputs:
            fit_shuffles(df)
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Some of the session's settings while a job runs, then what they were."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate for a plan, None where the session does not expose it."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session, whose driver and executors are one process, may fall back to a
    temporary folder of this machine.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        named = tempfile.mkdtemp(prefix="shoptrail-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def new_shared_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
