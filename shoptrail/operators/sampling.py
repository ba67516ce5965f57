"""Exact fixed-size sampling and sequential ids."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoptrail import schemas as S
from shoptrail.session import cut_lineage

# Leading bytes of a digest that name its bucket: 65,536 buckets, whatever the input.
_BUCKET_BYTES = 2
# Parts of the range of numbers that are counted at a time, and rows that are ranked together at last.
_HISTOGRAM_PARTS = 4_096
_RANKED_ROWS = 100_000
# Copies of one row numbered by one task at a time.
_COPIES_PER_STEP = 100_000


def _row_text(columns: list[str]) -> Column:
    """One text per row in which NULL differs from empty and fields cannot run together."""
    parts = [
        F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
        for c in columns
    ]
    return F.concat(*parts)


def _copies(counted: DataFrame) -> DataFrame:
    """(row_digest, copies) to one row per copy, numbered from 1.

    A row repeated billions of times is cut into steps first, and the steps are dealt out to tasks
    before they are opened.
    """
    few = counted.where(F.col("copies") <= _COPIES_PER_STEP).select(
        "row_digest", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    )
    last_step = F.floor((F.col("copies") - 1) / _COPIES_PER_STEP)
    steps = (
        counted.where(F.col("copies") > _COPIES_PER_STEP)
        .withColumn("step", F.explode(F.sequence(F.lit(0), last_step)))
        .repartition("row_digest", "step")
    )
    first = F.col("step") * _COPIES_PER_STEP + 1
    last = F.least(F.col("copies"), first + _COPIES_PER_STEP - 1)
    many = steps.select("row_digest", F.explode(F.sequence(first, last)).alias("copy"))
    return few.select("row_digest", F.col("copy").cast("bigint")).unionByName(many)


@dataclass(frozen=True)
class Sample:
    rows: DataFrame
    scanned: int
    requested: int

    @property
    def short(self) -> bool:
        """The source had fewer rows than asked for."""
        return self.scanned < self.requested


def _smallest(keyed: DataFrame, n: int) -> tuple[DataFrame, int]:
    """(the ``n`` rows with the smallest ``sample_key``, how many rows there were).

    A histogram over the key's leading digits (a fixed number of buckets) finds the bucket the n-th
    key falls in. Buckets before it are kept whole; only that one is ranked. Keys are digests of
    distinct texts, so buckets hold even shares.
    """
    bucket = F.substring("sample_key", 1, _BUCKET_BYTES)
    sizes = keyed.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).collect()
    total = sum(row["n"] for row in sizes)
    if total <= n:
        return keyed, total
    taken = 0
    for name, size in sorted((bytes(row["bucket"]), row["n"]) for row in sizes):
        if taken + size >= n:
            break
        taken += size
    ranked = Window.partitionBy(bucket).orderBy("sample_key")
    part = (
        keyed.where(bucket == F.lit(name))
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= n - taken)
        .drop("_rank")
    )
    return keyed.where(bucket < F.lit(name)).unionByName(part), total


def _numbered(keys: DataFrame) -> DataFrame:
    """Add ``sample_number``, the row's place in key order from 1.

    Rows are ranked inside a bucket of the key; what earlier buckets hold is added from the
    histogram, which has a fixed number of rows.
    """
    bucketed = keys.withColumn("_bucket", F.substring("sample_key", 1, _BUCKET_BYTES))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy("sample_key"))
    placed = bucketed.withColumn("_place", place).join(F.broadcast(offsets), "_bucket")
    return placed.withColumn("sample_number", F.col("_before") + F.col("_place")).drop(
        "_bucket", "_before", "_place"
    )


def fixed_size_sample(df: DataFrame, n: int, seed: int = 42) -> Sample:
    """Uniform sample of exactly ``n`` rows without replacement (all rows if there are fewer).

    Every copy of every row gets a digest of (seed, row, number of the copy) and the n smallest
    win. The outcome depends on seed and content only, not on files or partitions. Digests and
    their counts are all that is shuffled, once; the rows themselves are fetched by the winning digests. Rows come with
    ``sample_key`` and their ``sample_number`` in key order.
    """
    if n <= 0:
        raise ValueError("sample size must be positive")
    columns = df.columns
    digest = F.unhex(F.md5(F.concat(F.lit(f"{seed}|"), _row_text(columns))))
    marked = df.withColumn("row_digest", digest)
    # The one shuffle over all rows: 16 bytes and a count, set down; the cut and the winners are read from that copy.
    counted = cut_lineage(marked.groupBy("row_digest").agg(F.count("*").alias("copies")))
    named = F.concat_ws("|", F.lower(F.hex("row_digest")), F.col("copy").cast("string"))
    keyed = _copies(counted).withColumn("sample_key", F.unhex(F.md5(named)))
    smallest, scanned = _smallest(keyed, n)
    # At most n narrow rows, read four times below; the scan behind them should run once.
    winners = cut_lineage(smallest.select("row_digest", "sample_key"))
    wanted = winners.select("row_digest")
    # Copies of a row are alike, so one of each is enough to serve all winners with its digest.
    contents = marked.join(wanted, "row_digest", "left_semi").dropDuplicates(["row_digest"])
    rows = _numbered(winners).join(contents, "row_digest")
    key = F.lower(F.hex("sample_key")).alias("sample_key")
    return Sample(rows.select(key, "sample_number", *columns), scanned, n)


def stamp_event_ids(sample: DataFrame, seed: int = 42) -> DataFrame:
    """Name sampled rows ``evt_<seed>_<10-digit sample number>``; columns the source lacks and
    fields without a value come out blank."""
    fields = [
        (F.coalesce(F.col(name), F.lit("")) if name in sample.columns else F.lit("")).alias(name)
        for name in S.SOURCE_CSV.names
    ]
    event_id = F.format_string(S.EVENT_ID_PATTERN, F.lit(str(seed)), "sample_number")
    return sample.select(event_id.alias("event_id"), *fields)


def first_rows(df: DataFrame, n: int, position: str) -> DataFrame:
    """The first ``n`` rows in the order of a whole number, rows without one last, whatever ``n`` is.

    The n-th number is found from histograms of the numbers' range, refined until the part it lies in is small or a
    single value. Rows below that part are taken by a filter, and only the part is ranked, so no task holds ``n`` rows.
    Of rows with the same number any are taken.
    """
    key = F.col(position).cast("bigint")
    edge = df.agg(F.count(key).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).first()
    if edge["n"] <= n:
        missing = df.where(key.isNull())
        first = df.where(key.isNotNull()).orderBy(position)
        if edge["n"] == n:
            return first
        return first.unionByName(_any_rows(missing, n - edge["n"]))
    low, high, before, inside = edge["low"], edge["high"], 0, edge["n"]
    while inside > _RANKED_ROWS and low < high:
        width = -(-(high - low + 1) // _HISTOGRAM_PARTS)
        # Whole-number division of decimals: exact, and no difference of two numbers is too large.
        part = F.expr(f"(CAST(`{position}` AS DECIMAL(38, 0)) - ({low}BD)) DIV ({width}BD)")
        sizes = df.where(key.between(low, high)).groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
        for row in sorted(sizes, key=lambda r: r["part"]):
            if before + row["n"] >= n:
                low, inside = low + row["part"] * width, row["n"]
                high = min(high, low + width - 1)
                break
            before += row["n"]
    last = df.where(key.between(low, high))
    ranked = last.withColumn("_rank", F.row_number().over(Window.orderBy(key))).where(F.col("_rank") <= n - before).drop("_rank")
    return df.where(key < low).unionByName(ranked).orderBy(position)


def _any_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows (all, if fewer): as many whole partitions as fit, and some rows of one more."""
    placed = cut_lineage(df.withColumn("_part", F.spark_partition_id()))
    sizes = sorted((row["_part"], row["n"]) for row in placed.groupBy("_part").agg(F.count("*").alias("n")).collect())
    whole, left = [], n
    for part, size in sizes:
        if size > left:
            some = placed.where(F.col("_part") == part).limit(left)
            return placed.where(F.col("_part").isin(whole)).unionByName(some).drop("_part")
        whole.append(part)
        left -= size
    return placed.drop("_part")
