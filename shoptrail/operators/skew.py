"""Ordering inside groups that may be too big for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoptrail.session import cut_lineage

# A group below this many rows sorts comfortably (spilling if need be) in one task.
HEAVY_GROUP_ROWS = 20_000_000
# Keys are counted by this many hash buckets first.
KEY_BUCKETS = 65_536


def heavy_keys(df: DataFrame, key: str, rows: int = HEAVY_GROUP_ROWS) -> list:
    """All keys with at least ``rows`` rows, heaviest first: at most one per ``rows`` rows of input.

    Counts per hash bucket combine to a fixed number of rows before they are shuffled. Exact counts are
    taken only of keys in buckets that hold ``rows`` rows, which most input has none of.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS))
    full = df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).where(F.col("n") >= rows)
    buckets = [row["bucket"] for row in full.collect()]
    if not buckets:
        return []
    counts = df.where(bucket.isin(buckets)).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= rows)
    return [row[0] for row in counts.orderBy(F.desc("n"), key).select(key).collect()]


def split_by_keys(df: DataFrame, key: str, keys: list) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is listed, all other rows); a NULL key counts as not listed."""
    listed = F.coalesce(F.col(key).isin(keys), F.lit(False))
    return df.where(listed), df.where(~listed)


def number_in_slices(
    df: DataFrame, group: str, order: list[str], number: str, measures: dict[str, tuple[Column, str]]
) -> DataFrame:
    """Number the rows of each group from 1 in ``order``, however big a group is.

    A range shuffle over (group, order) lays each group out over as many partitions as its size
    asks for. Each partition numbers its own rows; what comes before it is a running total over one
    small row per (group, partition). ``measures`` maps a new column to (expression, "min" or
    "max"), taken over the whole group the same way.

    ``order`` must be total within a group. The partition boundaries come from sampling and could
    differ between two runs of the shuffle, so the laid-out rows are checkpointed and both passes
    read that copy.
    """
    layout = [F.col(group), *[F.col(c).asc_nulls_last() for c in order]]
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid_out = df.repartitionByRange(slices, *layout).sortWithinPartitions(*layout)
    # The id's upper bits are the partition, its lower 33 bits the position inside it.
    placed = cut_lineage(laid_out.withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_slice", F.shiftright("_place", 33))

    runs = placed.groupBy(group, "_slice").agg(
        F.min("_place").alias("_first"),
        F.count("*").alias("_rows"),
        *[getattr(F, how)(expr).alias(name) for name, (expr, how) in measures.items()],
    )
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        group,
        "_slice",
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        *[getattr(F, how)(name).over(whole).alias(name) for name, (_, how) in measures.items()],
    )
    # One row per (group, slice): at most slices + groups of them, both bounded by construction.
    joined = placed.join(F.broadcast(starts), [group, "_slice"])
    return joined.withColumn(number, F.col("_place") + F.col("_shift")).drop("_place", "_slice", "_shift")
