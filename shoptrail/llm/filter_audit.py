"""Filter interaction audit: what each filter removes, in every order of applying them.

Whether a document is an exact copy is found with radix tries over whole texts. Texts are dealt into ranges by
prefixes that grow only where many bytes share them; each range's texts are inserted into a compressed trie whose
terminals hold the smallest id, and a walk over the trie flags the copies. What a document fails is then a mask of
five bits, so counts per mask answer every order of the filters.

    A  under 200 words                          D  holds one of # $ % & * |
    B  distinct words under half of all          E  same text as a smaller id, table-wide
    C  capitals A-Z over 2 % of all characters
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import permutations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from shoptrail.llm.common import cut_lineage, slices

FILTERS = "ABCDE"
A, B, C, D, E = (1 << i for i in range(len(FILTERS)))
MIN_WORDS, LEAST_DISTINCT_PERCENT, MOST_UPPER_PERCENT = 200, 50, 2
SYMBOLS = re.compile(rb"[#$%&*|]")
UPPER = bytes(range(ord("A"), ord("Z") + 1))
#: Bytes that continue a character in UTF-8.
_CONTINUED = bytes(range(0x80, 0xC0))

#: A range of texts holds about this many bytes, less where the whole is small; no more ranges than that are made.
RANGE_BYTES = 64 << 20
MOST_RANGES = 1 << 17
#: Bytes of a text that decide on one level of the prefixes.
STEP = 2
#: Copies are collapsed before the shuffle within so many bytes of different texts of a task.
COLLAPSED_BYTES = 16 << 20
ROWS = 1_000


def failures(data: bytes) -> int:
    """Which of A to D a text fails. ``bytes.split`` cuts at the blanks 0x20 and 0x09 to 0x0D."""
    words = data.split()
    mask = A if len(words) < MIN_WORDS else 0
    if 100 * len(set(words)) < LEAST_DISTINCT_PERCENT * len(words):
        mask |= B
    if 100 * (len(data) - len(data.translate(None, UPPER))) > MOST_UPPER_PERCENT * len(data.translate(None, _CONTINUED)):
        mask |= C
    if SYMBOLS.search(data):
        mask |= D
    return mask


def common_length(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high - 1:  # a[:low] == b[:low], a[:high] != b[:high]
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low


@dataclass
class Level:
    """Texts that share their first ``depth`` bytes, parted by the next ``STEP`` bytes.

    ``targets[i]`` belongs to those from ``starts[i]`` on: a range's number, or ``~n`` for level ``n``. A level
    without starts is open: it has not been counted yet.
    """

    depth: int
    probe: int
    starts: list[bytes] = field(default_factory=list)
    targets: list[int] = field(default_factory=list)


class Prefixes:
    """The adaptive prefixes, as a radix tree of levels. All texts of a level share what stands before its depth,
    so only ``STEP`` bytes are kept per part: at most some 3 * ``MOST_RANGES`` parts in all."""

    def __init__(self) -> None:
        self.levels, self.ranges = [Level(0, 64)], 0

    def place(self, data: bytes) -> int:
        """Number of a text's range, or ``~n`` if it comes to the open level ``n``."""
        at = 0
        while True:
            level = self.levels[at]
            if not level.starts:
                return ~at
            key = data[level.depth : level.depth + STEP]
            target = level.targets[max(0, bisect_right(level.starts, key) - 1)]
            if target >= 0:
                return target
            at = ~target


def _weigh(sent):
    """Bytes of texts at each part of the open levels; of equal texts in a task one counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes, seen = sent.value, set()
        found: dict[tuple[int, bytes], list] = {}
        for part in slices(batches, ROWS):
            for data in part.column(0).to_pylist():
                at = ~prefixes.place(data)
                if at < 0:
                    continue
                name = xxhash.xxh3_64_intdigest(data)
                if name in seen:
                    continue
                if len(seen) > 1_000_000:  # weights only balance the ranges
                    seen.clear()
                seen.add(name)
                level = prefixes.levels[at]
                shown = data[level.depth : level.depth + level.probe]
                row = found.setdefault((at, shown[:STEP]), [0, shown, shown, 0])
                row[0] += len(data) + 32
                row[1], row[2], row[3] = min(row[1], shown), max(row[2], shown), max(row[3], len(data))
        rows = [(at, key, *row) for (at, key), row in found.items()]
        columns = list(zip(*rows)) if rows else [()] * 6
        kinds = [pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        names = ["level", "key", "weight", "low", "high", "longest"]
        yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names=names)

    return run


def adaptive_prefixes(texts: DataFrame, range_bytes: int = RANGE_BYTES) -> Prefixes:
    """Ranges of the texts (one binary column) with about ``range_bytes`` each.

    Round by round the texts of each open level are weighed by their next two bytes. Neighbouring parts are put
    together up to a range's size; a part that is larger by itself becomes a level of its own, which begins
    where its texts first differ, so a round is spent on each branching only. A part that holds a single text ends.
    The driver sees one row per range or level.
    """
    spark, prefixes, share = texts.sparkSession, Prefixes(), None
    while any(not level.starts for level in prefixes.levels):
        sent = spark.sparkContext.broadcast(prefixes)
        weighed = texts.mapInArrow(_weigh(sent), "level int, key binary, weight bigint, low binary, high binary, longest bigint")
        weighed = cut_lineage(
            weighed.groupBy("level", "key").agg(
                F.sum("weight").alias("weight"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("longest").alias("longest")
            )
        )
        if share is None:
            total = weighed.agg(F.sum("weight")).first()[0] or 0
            wanted = min(range_bytes, total // (4 * spark.sparkContext.defaultParallelism))
            share = max(1, wanted, total // MOST_RANGES)
        before = F.sum("weight").over(Window.partitionBy("level").orderBy("key").rowsBetween(Window.unboundedPreceding, -1))
        heavy = F.col("weight") > share
        parts = (
            weighed.withColumns({"heavy": heavy, "bin": F.floor(F.coalesce(before, F.lit(0)) / share)})
            .groupBy("level", "bin", "heavy")
            .agg(F.min("key").alias("start"), F.min("low").alias("low"), F.max("high").alias("high"), F.max("longest").alias("longest"))
            .collect()
        )
        opened = [n for n, level in enumerate(prefixes.levels) if not level.starts]
        found = defaultdict(list)
        for row in parts:
            found[row["level"]].append(row)
        for n in opened:
            level = prefixes.levels[n]
            for row in sorted(found[n], key=lambda r: bytes(r["start"])):
                low, high = bytes(row["low"]), bytes(row["high"])
                same = common_length(low, high)
                level.starts.append(bytes(row["start"]))
                if row["heavy"] and (low != high or row["longest"] > level.depth + level.probe):
                    level.targets.append(~len(prefixes.levels))
                    prefixes.levels.append(Level(level.depth + same, 4 * level.probe if low == high else level.probe))
                else:
                    level.targets.append(prefixes.ranges)
                    prefixes.ranges += 1
            if not level.starts:  # no texts at all
                level.starts, level.targets = [b""], [0]
        sent.destroy()
    return prefixes


class Trie:
    """Compressed trie of texts. A node is [label, children by first byte, smallest id, rows]."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None, []]

    def insert(self, data: bytes, key: int, row: tuple) -> None:
        node, at = self.root, 0
        while at < len(data):
            child = node[1].get(data[at])
            if child is None:
                child = node[1][data[at]] = [data[at:], {}, None, []]
                node, at = child, len(data)
                continue
            label = child[0]
            if data.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = common_length(label, data[at : at + len(label)])
            upper = node[1][data[at]] = [label[:same], {label[same]: child}, None, []]
            child[0] = label[same:]
            node, at = upper, at + same
        if node[2] is None or key < node[2]:
            node[2] = key
        node[3].append((key, *row))

    def terminals(self) -> Iterator[tuple[int, list[tuple]]]:
        """Smallest id and rows of each text."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            stack.extend(node[1].values())
            if node[3]:
                yield node[2], node[3]


_ROW = "range int, body binary, id bigint, part string, mask int, n bigint"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
    columns = list(zip(*rows)) if rows else [()] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(x, kind) for x, kind in zip(columns, kinds)], names=["range", "body", "id", "part", "mask", "n"]
    )


def _prepare(sent):
    """Masks of A to D, and one row per text that may be the first of its kind.

    Within a task a row whose text a smaller id has is a copy for sure, so only rows of the smallest id carry
    their text on: a text of a third of all rows is shuffled once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prefixes = sent.value
        held: dict[bytes, dict] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            out = []
            for data, counts in held.items():
                mask = failures(data)
                first = min((key for key, _ in counts if key is not None), default=None)
                for (key, part), n in counts.items():
                    if key is not None and key == first:
                        out.append((prefixes.place(data), data, key, part, mask, n))
                    else:  # settled; dealt over tasks by id
                        out.append((-1 - (key or 0) % 4093, None, key, part, mask if key is None else mask | E, n))
                if len(out) >= ROWS:
                    yield _rows(out)
                    out = []
            yield _rows(out)

        for piece in slices(batches, ROWS):
            for data, key, part in zip(*(column.to_pylist() for column in piece.columns)):
                counts = held.get(data)
                if counts is None:
                    counts = held[data] = {}
                    size += len(data)
                if (key, part) not in counts:
                    counts[key, part] = 0
                    size += 64
                counts[key, part] += 1
            if size > COLLAPSED_BYTES:
                yield from flush()
                held, size = {}, 0
        yield from flush()

    return run


def _flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One trie per range; rows come in the order of ranges."""
    now, trie = None, Trie()

    def closed() -> Iterator[pa.RecordBatch]:
        out = []
        for least, rows in trie.terminals():
            out += [(0, None, key, part, mask | E if key > least else mask, n) for key, part, mask, n in rows]
            if len(out) >= ROWS:
                yield _rows(out)
                out = []
        yield _rows(out)

    for piece in slices(batches, ROWS):
        settled = []
        for number, body, key, part, mask, n in zip(*(column.to_pylist() for column in piece.columns)):
            if number < 0:
                settled.append((0, None, key, part, mask, n))
                continue
            if number != now:
                yield from closed()
                now, trie = number, Trie()
            trie.insert(body, key, (part, mask, n))
        yield _rows(settled)
    yield from closed()


def masks(docs: DataFrame, text: str = "text", part: str = "source", id_column: str = "doc_id", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, part, mask, n): which filters the rows of ``docs`` fail, counted.

    Null texts count as empty, null parts as the empty part. A row without id has no smaller id and is none: it
    never fails E and makes no other row fail it. Rows that share the smallest id of a text pass E all. Texts are
    shuffled once, one row per different text of a task; tries are as large as a range.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = docs.select(body.alias("body"), F.col(id_column).cast("bigint").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    prefixes = adaptive_prefixes(narrow.select("body"), range_bytes)
    sent = docs.sparkSession.sparkContext.broadcast(prefixes)
    prepared = narrow.mapInArrow(_prepare(sent), _ROW)
    flagged = prepared.repartition("range").sortWithinPartitions("range").mapInArrow(_flag, _ROW)
    return flagged.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))


def _sum(field_name: str, where) -> Column:
    """Sum of a field over the masks of a part that meet a condition."""
    add = lambda total, x: total + F.when(where(x["mask"]), x[field_name]).otherwise(F.lit(0).cast("bigint"))
    return F.aggregate("masks", F.lit(0).cast("bigint"), add)


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source", id_column: str = "doc_id") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): one row for
    each part, each of the 120 orders and each of its five steps.

    ``labels`` gives (id, quality, toxic); a document is good or toxic if any of its label rows says so, null
    labels and ids say nothing. Without documents there are no parts and no rows. ``shapley`` sums what a filter removes over all
    orders: a document that fails k filters is removed by each of them in 120 / k orders.
    """
    known = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("bigint").alias("id")).agg(
        F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
        F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
    )
    failed = masks(docs, text, part, id_column)
    counted = failed.join(known, "id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    # At most 32 masks per part.
    parts = cut_lineage(counted.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")))
    orders = ",".join(map("".join, permutations(FILTERS)))
    bit = lambda letter: F.element_at(F.create_map(*[x for i, f in enumerate(FILTERS) for x in (F.lit(f), F.lit(1 << i))]), letter)
    steps = (
        parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("letters", F.split("filter_order", ""))
        .withColumn("own", bit(F.get("letters", F.col("step") - 1)))
        .withColumn("before", F.aggregate(F.slice("letters", F.lit(1), F.col("step") - 1), F.lit(0), lambda total, x: total + bit(x)))
    )
    own, before = F.col("own"), F.col("before")
    fails = lambda mask: mask.bitwiseAND(own) != 0
    earlier = lambda mask: mask.bitwiseAND(before) != 0
    removed = lambda mask: fails(mask) & ~earlier(mask)
    shares = F.array(*[F.lit(math.factorial(len(FILTERS)) // k).cast("bigint") for k in range(1, len(FILTERS) + 1)])
    summed = lambda x: F.when(fails(x["mask"]), F.element_at(shares, F.bit_count(x["mask"])) * x["n"]).otherwise(F.lit(0).cast("bigint"))
    return steps.select(
        "part", "filter_order", "step",
        _sum("n", lambda mask: ~fails(mask) & ~earlier(mask)).alias("kept"),
        _sum("n", removed).alias("removed"),
        _sum("n", lambda mask: fails(mask) & earlier(mask)).alias("redundant"),
        _sum("n", lambda mask: mask == own).alias("unique_fails"),
        _sum("good", removed).alias("good_lost"),
        _sum("toxic", removed).alias("toxic_lost"),
        F.aggregate("masks", F.lit(0).cast("bigint"), lambda total, x: total + summed(x)).alias("shapley"),
    )
