"""Publish the curated layer, and list what is there."""

from __future__ import annotations

import posixpath
from functools import reduce
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoptrail import schemas as S
from shoptrail.session import cut_lineage, settings
from shoptrail.sources import differences
from shoptrail.sources.layers import drop_path, path_exists, read_layer


def check_prefix(prefix: str) -> str:
    """Only the curated prefix may be published to."""
    bare = prefix.strip().strip("/")
    if bare != S.CURATED_PREFIX:
        raise ValueError(f"prefix must be '{S.CURATED_PREFIX}', not {prefix!r}")
    return bare


def check_source(root: str) -> str:
    """Only a folder named like the curated layer may be published from."""
    bare = posixpath.normpath(urlsplit(root).path)
    parts = [part.lower() for part in bare.split("/")]
    if posixpath.basename(bare) != S.CURATED_PREFIX:
        kind = "a private layer" if set(parts) & set(S.PRIVATE_LAYERS) else "not the curated layer"
        raise ValueError(f"refusing to publish {root}: {kind}")
    return root.rstrip("/")


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """(path, table_name, bytes) of publishable files under a curated root.

    Lists Parquet and JSON only. Spark's listing, itself a job where there are many folders, leaves out names that
    start with a dot or an underscore. Contents are not read, so splits of files have no use: tasks are dealt by numbers of
    files, and the list is set down once.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = reader.option("pathGlobFilter", "*.{parquet,json}").load(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no curated layer at {root}") from error
        raise
    table = F.regexp_extract("path", rf"/{S.CURATED_PREFIX}/([^/]+)", 1)
    listed = files.select("path", table.alias("table_name"), F.col("length").alias("bytes"))
    whole = {"spark.sql.files.maxPartitionBytes": str(1 << 60), "spark.sql.files.openCostInBytes": str(1 << 40)}
    with settings(spark, whole):
        return cut_lineage(listed)


def inventory_rows(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, row_count): rows in the listed Parquet files of each table, and 0 for documents."""
    files = inventory(spark, root).withColumn("file", F.col("path"))
    tables = [row["table_name"] for row in files.where(F.col("path").endswith(".parquet")).select("table_name").distinct().collect()]
    counts = None
    for name in sorted(tables):  # the curated layer's tables, a handful
        rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root.rstrip('/')}/{name}")
        part = rows.groupBy(_bare("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"))
        counts = part if counts is None else counts.unionByName(part)
    listed = files.withColumn("file", _bare("path"))
    if counts is not None:
        listed = listed.join(counts, "file", "left")
    else:
        listed = listed.withColumn("n", F.lit(None).cast("bigint"))
    return listed.groupBy("table_name").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))


def _bare(path: str):
    """A path without scheme, as listings and scans write it differently."""
    return F.regexp_replace(F.regexp_replace(path, "^[a-z0-9]+:/*", "/"), "%20", " ")


def inventory_totals(files: DataFrame) -> DataFrame:
    return files.groupBy("table_name").agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )


def publish(
    spark: SparkSession, source_root: str, target: str, prefix: str = S.CURATED_PREFIX,
    dry_run: bool = False,
) -> dict[str, int]:
    """Make ``target/prefix`` hold what the curated layer holds, on any file system.

    Partitions of declared tables, and other Parquet folders as a whole, are written only where their rows or their
    published files are not what the last publication left (see ``differences``). Empty tables are published too, other
    folders go by their own schema and partitions, and JSON documents, small by nature, are copied each time from
    wherever they lie. What the source no longer has is removed. Returns files and bytes, of the source in a dry run,
    else of the target, and the numbers of partitions written and removed, which a dry run tells beforehand.
    """
    source = check_source(source_root)
    destination = f"{target.rstrip('/')}/{check_prefix(prefix)}"
    files = inventory(spark, source)
    present = inventory_totals(files).collect()
    if not present:
        raise ValueError(f"nothing to publish under {source}")
    names = {row["table_name"] for row in present}
    parquet = {r["table_name"] for r in files.where(F.col("path").endswith(".parquet")).select("table_name").distinct().collect()}
    layers = {
        name: read_layer(spark, f"{source}/{name}", schema) if name in parquet else spark.createDataFrame([], schema)
        for name, (schema, _) in S.GOLD.items()
    }
    others = {name: _read_other(spark, f"{source}/{name}") for name in sorted(parquet - set(S.GOLD))}
    partitions = {name: partition for name, (_, partition) in S.GOLD.items()} | dict.fromkeys(others)
    frames = {**layers, **others}
    # One row per partition, needed three times.
    rows = cut_lineage(reduce(DataFrame.unionByName, [differences.facts(df, name, partitions[name]) for name, df in frames.items()]))
    there = differences.listed_parts(inventory(spark, destination) if path_exists(spark, destination) else files.limit(0), partitions)
    todo = differences.compare(rows, differences.read_manifest(spark, destination), there, list(frames))
    counted = {
        "partitions_written": sum(len(what.write) for what in todo.values()),
        "partitions_removed": sum(len(what.remove) for what in todo.values()),
    }
    if not dry_run:
        if any(todo.values()):
            drop_path(spark, f"{destination}/{differences.MANIFEST}")
        _remove_others(spark, destination, names | set(S.GOLD) | {differences.MANIFEST})
        for name, layer in layers.items():
            if todo[name]:
                differences.apply(layer, f"{destination}/{name}", partitions[name], todo[name])
        for name, df in others.items():
            if todo[name]:
                _copy_other(df, files.where(F.col("table_name") == name), f"{destination}/{name}")
        for path in _below(files.where(F.col("path").endswith(".json")), source):
            _copy_file(spark, f"{source}/{path}", f"{destination}/{path}")
        published = inventory(spark, destination)
        present = inventory_totals(published).collect()
        if any(todo.values()):
            differences.write_manifest(rows, differences.listed_parts(published, partitions), destination)
    return {"files": sum(r["files"] for r in present), "bytes": sum(r["bytes"] for r in present), **counted}


def _below(files: DataFrame, source: str) -> list[str]:
    """Paths of JSON documents below the root: summaries, a few a run."""
    root = f"/{posixpath.basename(posixpath.normpath(urlsplit(source).path))}/"
    return [row["path"].rsplit(root, 1)[1] for row in files.select("path").collect()]


def _read_other(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(folder)


def _copy_other(frame: DataFrame, files: DataFrame, destination: str) -> None:
    """A Parquet folder that is no declared table, with the partition folders it has."""
    keys = F.explode(F.expr(r"regexp_extract_all(path, '/([^/=]+)=[^/]*', 1)"))
    found = [row["k"] for row in files.where(F.col("path").endswith(".parquet")).select(keys.alias("k")).distinct().collect()]
    frame.write.mode("overwrite").partitionBy(*[c for c in frame.columns if c in found]).parquet(destination)


def _file_system(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove_others(spark: SparkSession, folder: str, names: set[str]) -> None:
    """Delete what lies in a published folder under other names."""
    path, system = _file_system(spark, folder)
    for status in system.listStatus(path) if system.exists(path) else []:
        if status.getPath().getName() not in names:
            system.delete(status.getPath(), True)


def _copy_file(spark: SparkSession, source: str, destination: str) -> None:
    (origin, here), (goal, there) = _file_system(spark, source), _file_system(spark, destination)
    if there.exists(goal):
        there.delete(goal, True)
    copy = spark._jvm.org.apache.hadoop.fs.FileUtil.copy
    copy(here, origin, there, goal, False, True, spark._jsc.hadoopConfiguration())
