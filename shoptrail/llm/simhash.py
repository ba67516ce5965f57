"""SimHash near-duplicates, found with pivot distance tables.

A document's fingerprint has 64 bits; documents whose fingerprints differ in two bits or fewer are linked. For each
distinct fingerprint the Hamming distances to ``PIVOTS`` reference fingerprints are computed once. By the triangle
inequality two fingerprints within two bits have distances within two to every reference, so a pair is dropped as soon
as one coordinate differs by more; what is left is verified on the fingerprints themselves.

Distances to references crowd around 32 whatever the references, so a table alone would leave a join of all pairs.
Fingerprints therefore meet in buckets first: of four quarters of the bits two bits can touch two, so two quarters are
the same, and a pair shares one of six buckets. No pair is lost by that.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from shoptrail.llm.common import cut_lineage, slices
from shoptrail.llm.jaccard_join import components

SHINGLE_WORDS = 3
SEED = 42
MOST_DIFFERENT = 2
#: Reference fingerprints.
PIVOTS = 16
#: Pairs of quarters that name a bucket.
QUARTERS = tuple(combinations(range(4), 2))
#: Members of a bucket that one task compares with as many others at a time.
BLOCK = 2_048
#: Hashes whose bits are counted at a time.
HASHES = 1 << 15


def fingerprint(data: bytes) -> int:
    """Fingerprint of a text: a bit is set if over half of the hashes of its shingles have it.

    A-Z become a-z; words end at the blanks 0x20 and 0x09 to 0x0D, as ``bytes.split`` cuts. Shingles are three words, repeats
    included; a text of fewer words is one shingle, and one without words has the fingerprint zero.
    """
    words = data.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    begins, at = [], 0
    for word in words:
        begins.append(at)
        at += len(word) + 1
    ends = [begin - 1 for begin in begins[SHINGLE_WORDS:]]
    ends.append(len(joined))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[b:e], SEED) for b, e in zip(begins, ends)]
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), HASHES):
        bits = np.asarray(hashes[k : k + HASHES], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, fp) of each row, ``fp`` as a signed 64-bit integer. Null texts count as empty; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 256):
            found = np.asarray([fingerprint(x) for x in part.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return narrow.mapInArrow(run, "id bigint, fp bigint")


def references(n: int = PIVOTS) -> np.ndarray:
    """Fixed reference fingerprints, the same in every process."""
    return np.asarray([xxhash.xxh64_intdigest(f"reference {i}", SEED) for i in range(n)], np.uint64)


def distance_table(distinct: DataFrame, pivots: int = PIVOTS) -> DataFrame:
    """Add ``table``: a byte for the Hamming distance to each reference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = references(pivots)
        for part in batches:
            fp = part.column(part.schema.get_field_index("fp")).to_numpy(zero_copy_only=False).view(np.uint64)
            far = np.bitwise_count(fp[:, None] ^ to[None, :]).astype(np.uint8)
            table = pa.array([row.tobytes() for row in far], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, table], names=[*part.schema.names, "table"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in distinct.schema)
    return distinct.mapInArrow(run, f"{fields}, table binary")


class _Forest:
    """Parts joined by links, as the smallest member of each."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.root[x]
            if (up == x).all():
                return x
            x = up

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.find(i), self.find(j)
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low < high
            if not open_.any():
                return
            np.minimum.at(self.root, high[open_], low[open_])
            i, j = i[open_], j[open_]


def linked(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, most: int = MOST_DIFFERENT) -> tuple[np.ndarray, np.ndarray]:
    """Of candidate pairs those within ``most`` bits: coordinates of the table drop pairs one by one, survivors are verified."""
    for k in range(table.shape[1]):
        near = np.abs(table[i, k] - table[j, k]) <= most
        i, j = i[near], j[near]
        if not len(i):
            return i, j
    near = np.bitwise_count(fp[i] ^ fp[j]) <= most
    return i[near], j[near]


def _candidates(first: np.ndarray, begins: np.ndarray, ends: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i < j) of members of one bucket part whose first coordinates differ by ``most`` at most. Members are sorted
    by that coordinate within their part ``begins[i]`` to ``ends[i]``; yields a distance in that order at a time."""
    i, step = np.arange(len(first)), 1
    while True:
        i = i[i + step < ends[i]]
        i = i[first[i + step] - first[i] <= most]
        if not len(i):
            return
        yield i, i + step
        step += 1


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within bucket parts as spanning forests: (a, b), b the smallest fingerprint that a is joined with here.

    Rows come sorted by part and first coordinate. A part is never cut: its rows are held over to the next batch. Parts have
    at most some 2 * BLOCK members, so a step works on a batch and one part."""
    names = ("bucket", "i", "j", "side", "fp", "table")
    held: pa.Table | None = None

    def work(rows: pa.Table) -> pa.RecordBatch:
        part = np.stack([rows.column(n).to_numpy().astype(np.int64) for n in ("bucket", "i", "j")], axis=1)
        side, fp = rows.column("side").to_numpy(), rows.column("fp").to_numpy().view(np.uint64)
        table = np.frombuffer(b"".join(rows.column("table").to_pylist()), np.uint8).reshape(len(fp), -1).astype(np.int16)
        new = np.flatnonzero(np.append(True, (part[1:] != part[:-1]).any(axis=1))) if len(fp) else np.zeros(0, int)
        sizes = np.diff(np.append(new, len(fp)))
        begins, ends = np.repeat(new, sizes), np.repeat(new + sizes, sizes)
        within = part[:, 1] == part[:, 2]
        forest = _Forest(len(fp))
        for i, j in _candidates(table[:, 0], begins, ends, MOST_DIFFERENT):
            met = within[i] | (side[i] != side[j])  # members of one block meet in that block's own part
            forest.link(*linked(fp, table, i[met], j[met]))
        root = forest.find(np.arange(len(fp)))
        joined = np.flatnonzero(root != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[joined]), pa.array(signed[root[joined]])], names=["a", "b"])

    for batch in batches:
        rows = pa.Table.from_batches([batch]).select(names)
        rows = rows if held is None else pa.concat_tables([held, rows])
        key = np.stack([rows.column(n).to_numpy().astype(np.int64) for n in names[:3]], axis=1)
        if not len(key):
            continue
        last = np.flatnonzero((key != key[-1]).any(axis=1))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield work(rows.slice(0, cut).combine_chunks())
        held = rows.slice(cut).combine_chunks()
    if held is not None:
        yield work(held)


def links(distinct: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b) pairs that join all fingerprints within two bits of each other, fewer than two per member of a bucket part.

    ``distinct`` holds each fingerprint once (column ``fp``). A fingerprint goes to its six buckets; buckets of one are left out. Members of
    a larger bucket are dealt into blocks by digest, and each two blocks are a part of their own."""
    told = distance_table(distinct.select("fp"))
    quarter = [F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF)) for q in range(4)]
    buckets = F.array(*[
        F.lit(k).cast("bigint") * F.lit(1 << 32) + quarter[a] * F.lit(1 << 16) + quarter[b] for k, (a, b) in enumerate(QUARTERS)
    ])
    members = cut_lineage(told.select("fp", "table", F.explode(buckets).alias("bucket")))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(5)), F.col("blocks")).cast("int")
    dealt = (
        members.join(sizes, "bucket")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"), "fp", "table",
        )
    )
    parted = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", F.substring("table", 1, 1), "fp")
    return parted.mapInArrow(_compare, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, fingerprint, component_id) of each row: the fingerprint as 16 hexadecimal digits, and the smallest id that chains
    of links reach, its own included.

    Rows without words (null, empty, blank) have the fingerprint zero and are linked like any other. Repeated rows are
    rows of their own with the same result. A row without id is linked but never names its component; a component
    of such rows only has none.
    """
    marked = cut_lineage(fingerprints(docs, text, id_column))
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(distinct))
    parts = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = parts.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = parts.join(named, "root").select("fp", "component_id")
    return marked.join(by_print, "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
