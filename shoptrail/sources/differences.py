"""What a published folder holds, by table and partition, so that only what changed is written again.

The manifest beside the published tables has a row per partition: rows, a digest of them that doesn't depend on their
order or files, and the files and bytes that the writing left. A partition is unchanged where its rows at the source have
the same count and digest and its files are still those. A row per table, under the part ``*``, stands for its columns.
The manifest goes before anything is written and comes back at the end, so a publication that broke off is followed by a
whole one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoptrail.sources.layers import drop_path, path_exists, write_layer

#: Names that start so are no part of a layer to Spark's readers, nor to the inventory.
MANIFEST = "_published"
#: How Spark names the partition folder of NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
WHOLE = "*"
_ROW = "table_name string, part string, n_rows bigint, digest decimal(38,0), files bigint, bytes bigint"


def part_name(partition: str | None) -> Column:
    """Value of the partition column as in its folder's name; empty for a table without one."""
    return F.coalesce(F.col(partition).cast("string"), F.lit(NO_VALUE)) if partition else F.lit("")


def facts(df: DataFrame, table: str, partition: str | None) -> DataFrame:
    """(table_name, part, n_rows, digest) of each partition, and of the columns. One scan, combined before it shuffles.

    Digests are added up, so repeated rows count. Flags tell which columns are NULL, as a hash passes over them.
    """
    columns = sorted(name for name in df.columns if name != partition)
    hashable = [F.to_json(F.struct(f"`{name}`")) if _nested(df, name) else F.col(f"`{name}`") for name in columns]
    digest = F.xxhash64(*hashable, *[F.col(f"`{name}`").isNull() for name in columns]).cast("decimal(20,0)")
    parts = df.groupBy(part_name(partition).alias("part")).agg(
        F.count("*").alias("n_rows"), F.sum(digest).cast("decimal(38,0)").alias("digest")
    )
    shape = ",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in df.schema))
    whole = df.sparkSession.range(1).select(
        F.lit(WHOLE).alias("part"), F.lit(0).cast("bigint").alias("n_rows"), F.xxhash64(F.lit(shape)).cast("decimal(38,0)").alias("digest")
    )
    return parts.unionByName(whole).withColumn("table_name", F.lit(table))


def _nested(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("map", "struct", "array", "variant")


def listed_parts(files: DataFrame, partitions: dict[str, str | None]) -> DataFrame:
    """(table_name, part, files, bytes) of the Parquet files in an inventory."""
    part = F.lit("")
    for table, column in partitions.items():
        if column:
            part = F.when(F.col("table_name") == table, F.regexp_extract("path", f"/{column}=([^/]*)/", 1)).otherwise(part)
    return (
        files.where(F.col("path").endswith(".parquet"))
        .groupBy("table_name", part.alias("part"))
        .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))
    )


@dataclass
class Difference:
    """Partitions of one table to write and to remove; ``whole`` where nothing of it can stay."""

    write: list[str] = field(default_factory=list)
    remove: list[str] = field(default_factory=list)
    whole: bool = False

    def __bool__(self) -> bool:
        return bool(self.whole or self.write or self.remove)


def compare(source: DataFrame, known: DataFrame, there: DataFrame, tables: list[str]) -> dict[str, Difference]:
    """What to do for each table: ``source`` facts, ``known`` manifest rows, ``there`` listed partitions.

    Joins of one row per partition; the driver takes their names, as a writer of partitions does.
    """
    keys = ["table_name", "part"]
    then = known.select(*keys, F.col("n_rows").alias("n_then"), F.col("digest").alias("d_then"), F.col("files").alias("f_then"), F.col("bytes").alias("b_then"))
    joined = source.join(then, keys, "full").join(there, keys, "full")
    intact = F.col("files").eqNullSafe(F.col("f_then")) & F.col("bytes").eqNullSafe(F.col("b_then"))
    same = (F.col("n_rows") == F.col("n_then")) & (F.col("digest") == F.col("d_then")) & intact
    state = F.when(F.col("n_rows").isNull(), "gone").when(F.coalesce(same, F.lit(False)), "same").otherwise("changed")
    found: dict[str, dict[str, list[str]]] = {name: {"gone": [], "same": [], "changed": []} for name in tables}
    for row in joined.select(*keys, state.alias("state")).collect():
        if row["table_name"] in found:
            found[row["table_name"]][row["state"]].append(row["part"])
    out = {}
    for name, by in found.items():
        kept = [part for part in by["same"] if part != WHOLE]
        changed = sorted(part for part in by["changed"] if part != WHOLE)
        gone = sorted(part for part in by["gone"] if part)  # files outside partition folders come with empty tables
        out[name] = Difference(changed, gone, WHOLE in by["changed"] or (not kept and bool(changed or gone)))
    return out


def apply(layer: DataFrame, path: str, partition: str | None, what: Difference) -> None:
    """Bring a published table up to date: changed partitions are overwritten, those gone removed."""
    if what.whole or (not partition and what):
        write_layer(layer, path, partition)
        return
    if what.write:
        write_layer(layer.where(part_name(partition).isin(what.write)), path, partition, only_touched_partitions=True)
    for part in what.remove:
        drop_path(layer.sparkSession, f"{path}/{partition}={part}")


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the manifest; none where there is no complete one."""
    path = f"{folder}/{MANIFEST}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return spark.createDataFrame([], _ROW)
    return spark.read.schema(_ROW).parquet(path)


def write_manifest(source: DataFrame, there: DataFrame, folder: str) -> None:
    rows = source.join(there, ["table_name", "part"], "left").select("table_name", "part", "n_rows", "digest", "files", "bytes")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{MANIFEST}")
