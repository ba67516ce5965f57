"""N-gram Jaccard similarity join by MinHash banding.

Documents with equal sets of five-word shingles are one class and go on as one representative.
Representatives that share a band of their MinHash signature are compared on their full shingle sets.
A bucket's members are compared in blocks, so a big bucket is many tasks; pairs are counted where they
are found and never written out: what leaves a task is a count per member and a spanning forest.
"""

from __future__ import annotations

import re
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from shoptrail.llm.common import add_columns, cut_lineage, free_name, texts_of

WORDS = 5
SIMILARITY = 0.8
#: Share of pairs at exactly the wanted similarity that share a band; bands with this many rows.
RECALL = 0.999
ROWS = 5
#: Members of a bucket that are compared with as many others by one task at a time.
BLOCK = 256
#: Stands for a null id, which comes after all others.
LAST = (1 << 63) - 1
#: Columns of a block's incidence matrix at a time.
COLUMNS = 8192

_BLANK = re.compile(r"[\x20\x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """Fewest bands of ``rows`` rows that a pair of that similarity shares one of with probability
    ``recall``: 1 - (1 - s^rows)^bands."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity**rows)))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def shingles(text: str | None, hashes: dict, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit digests of the distinct word n-grams of a text in lower case; a shorter text is one
    n-gram, a text without words has none."""
    found = [w for w in _BLANK.split((text or "").lower()) if w]
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - words + 1) if len(h) else 0
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(words, len(h))):
            out = (out ^ (out >> np.uint64(29))) * _MIX + h[k : k + n]
        out ^= out >> np.uint64(32)
    return np.unique(out)


def signatures(sets: list[np.ndarray], bands: int, rows: int = ROWS, seed: int = 1) -> np.ndarray:
    """Band digests (sets x bands) of non-empty sets."""
    factors = np.random.default_rng(seed).integers(1, 2**63, bands * rows, dtype=np.uint64) | np.uint64(1)
    begins = np.cumsum([0, *map(len, sets)])[:-1]
    every = np.concatenate(sets)
    out = np.zeros((len(sets), bands), np.uint64)
    with np.errstate(over="ignore"):
        for j, factor in enumerate(factors):
            mixed = every * factor
            mixed ^= mixed >> np.uint64(31)
            mixed *= _MIX
            least = np.minimum.reduceat(mixed, begins)
            band = j // rows
            out[:, band] = (out[:, band] ^ (out[:, band] >> np.uint64(27))) * _MIX + least + np.uint64(band)
    return out


def compare(a: list[np.ndarray], b: list[np.ndarray], similarity: float = SIMILARITY) -> np.ndarray:
    """Which pairs of the two lists of sets have at least that Jaccard similarity.

    Sizes of intersections come from products of 0/1 matrices, a part of the shingles at a time;
    shingles on one side only cannot meet and are left out.
    """
    shared = np.intersect1d(np.concatenate(a), np.concatenate(b))
    common = np.zeros((len(a), len(b)), np.float32)
    for at in range(0, len(shared), COLUMNS):
        part = shared[at : at + COLUMNS]
        sides = []
        for sets in (a, b):
            matrix = np.zeros((len(sets), len(part)), np.float32)
            for i, s in enumerate(sets):
                lo, hi = np.searchsorted(s, part[0]), np.searchsorted(s, part[-1], side="right")
                matrix[i, np.searchsorted(part, np.intersect1d(s[lo:hi], part, assume_unique=True))] = 1
            sides.append(matrix)
        common += sides[0] @ sides[1].T
    union = np.asarray([float(len(s)) for s in a])[:, None] + np.asarray([float(len(s)) for s in b])[None, :] - common
    return common >= similarity * union - 1e-9


def _sign(bands: int, words: int):
    def make():
        hashes = _WordHashes()

        def signed(column: pa.Array) -> tuple[list, list]:
            sets = [shingles(x, hashes, words) for x in texts_of(column)]
            full = [i for i, s in enumerate(sets) if len(s)]
            found: list = [None] * len(sets)
            if full:
                for i, row in zip(full, signatures([sets[i] for i in full], bands).view(np.int64)):
                    found[i] = row.tolist()
            return [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], found

        return signed

    return make


def _block_pairs(similarity: float, words: int):
    """Links among the members of one block pair of a bucket. A pair belongs to the first band that
    its two members share, so it is counted once however many buckets they meet in."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        band, _, first, second = key
        group = group.drop_duplicates(["rep", "side"]).sort_values("rep")
        sides = [group[group["side"] == s] for s in ((0, 1) if first != second else (0, 0))]
        hashes = _WordHashes()
        sets = [[shingles(x, hashes, words) for x in s["text"]] for s in sides]
        names, sizes = [s["rep"].to_numpy() for s in sides], [s["n"].to_numpy() for s in sides]
        linked = compare(*sets, similarity) if len(names[0]) and len(names[1]) else np.zeros((0, 0), bool)
        if linked.size:
            signed = [np.asarray(s["bands"].tolist(), np.int64)[:, :band] for s in sides]
            for k in range(band):
                linked &= signed[0][:, k][:, None] != signed[1][:, k][None, :]
            if first == second:
                np.fill_diagonal(linked, False)
        rows: dict = {}
        links = [(linked * sizes[1][None, :]).sum(axis=1)] if linked.size else []
        if linked.size and first != second:
            links.append((linked * sizes[0][:, None]).sum(axis=0))
        for side, counts in enumerate(links):
            for rep, n in zip(names[side], counts):
                if n:
                    rows[rep] = rows.get(rep, 0) + int(n)
        # A spanning forest: each member and the smallest member of its part of the block pair.
        root = {rep: rep for rep in rows}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for i, j in zip(*np.nonzero(linked)):
            x, y = find(names[0][i]), find(names[1][j])
            if x != y:
                root[max(x, y)] = min(x, y)
        out = [(rep, find(rep), n) for rep, n in rows.items()]
        return pd.DataFrame(out, columns=["rep", "root", "links"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (node, root): the smallest node of each connected part.

    Alternates large-star and small-star steps until nothing changes; each step is a narrow shuffle,
    kept by a reliable checkpoint. Rounds grow with the logarithm of the longest path.
    """
    def star(frame: DataFrame, large: bool) -> DataFrame:
        both = frame.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.unionByName(frame.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        joined = both.join(least, "u")
        moved = joined.where(F.col("v") > F.col("u")) if large else joined
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not large:
            out = out.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a != b").distinct()

    now = cut_lineage(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    state = None
    while True:
        now = cut_lineage(star(star(now, True), False))
        row = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = tuple(row)


def similar(docs: DataFrame, text: str = "text", id_column: str = "doc_id", similarity: float = SIMILARITY, words: int = WORDS, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: (id, class_id, n_links, is_first).

    ``class_id`` is the smallest id of the documents joined with this one by chains of links, ``n_links``
    the number of other rows with at least that similarity, and ``is_first`` marks the row of each class
    with the smallest id (then text digest). Null and empty texts are like no other: a class of their own each, with
    their own id. Repeated rows are documents of their own and link to each other; of rows with equal
    id and text in a class, ``is_first`` marks all, as nothing tells them apart. Ids must be integers;
    a null id comes after all others.
    """
    bands = bands_for(similarity, recall)
    plain = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
    )
    adds = {"set_key": ("binary", pa.binary()), "bands": ("array<bigint>", pa.list_(pa.int64()))}
    signed = cut_lineage(add_columns(plain, ["text"], adds, _sign(bands, words), drops=("text",)))
    place = F.struct(F.coalesce("id", F.lit(LAST)).alias("id"), "text_hash")
    # One representative per shingle set, named by its key; copies are counted before they are shuffled.
    classes = cut_lineage(
        signed.where("set_key is not null")
        .groupBy(F.col("set_key").alias("rep"))
        .agg(F.count("*").alias("n"), F.min(place).alias("at"), F.first("bands").alias("bands"))
    )
    members = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    # A bucket that holds the very same members as that of an earlier band would only repeat its pairs.
    buckets = (
        members.groupBy("band", "bucket")
        .agg(F.count("*").alias("size"), F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("who"))
        .where("size > 1")
    )
    chosen = buckets.groupBy("size", "who").agg(F.min(F.struct("band", "bucket")).alias("b")).select("b.*", "size")
    placed = cut_lineage(members.join(chosen, ["band", "bucket"]))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep", F.lit(3)), blocks).cast("int")
    dealt = (
        placed.withColumns({"blocks": blocks, "own": own})
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "rep", "band", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"),
        )
    )
    # Texts of the members of such buckets, few of all documents, are found by id and text digest.
    wanted = placed.select("rep").distinct().join(classes, "rep").select("rep", "n", "bands", "at.*")
    texts = (
        plain.withColumn("id", F.coalesce("id", F.lit(LAST)))
        .join(wanted, ["id", "text_hash"])
        .groupBy("rep")
        .agg(F.first("text").alias("text"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    )
    found = cut_lineage(
        dealt.join(texts, "rep")
        .groupBy("band", "bucket", "i", "j")
        .applyInPandas(_block_pairs(similarity, words), "rep binary, root binary, links bigint")
    )
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = classes.select("rep", "n", "at").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    joined = joined.withColumn("root", F.coalesce("root", "rep")).join(links, "rep", "left")
    firsts = joined.groupBy("root").agg(F.min("at").alias("first"))
    by_class = joined.join(firsts, "root").select(
        F.col("rep").alias("set_key"), "first", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    alone = F.col("set_key").isNull()
    return (
        signed.select("id", "text_hash", "set_key")
        .join(by_class, "set_key", "left")
        .select(
            F.col("id").alias(id_column),
            F.when(alone, F.col("id")).otherwise(F.nullif(F.col("first.id"), F.lit(LAST))).alias("class_id"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"), "text_hash",
            (alone | (place == F.col("first"))).alias("is_first"),
        )
    )


def keep_first(docs: DataFrame, text: str = "text", id_column: str = "doc_id", **options) -> DataFrame:
    """Rows of ``docs``, one of each class of similar documents: that with the smallest id. Of rows that
    repeat an id and a text one stays; empty and null texts are such rows only under the same id.

    Of rows that repeat id and text each task sends one on, so an id in a third of all rows stays harmless.
    """
    firsts = similar(docs, text, id_column, **options).where("is_first")
    key, digest, place = (free_name(docs, x) for x in ("key", "digest", "place"))
    named = lambda column, hashed: [F.coalesce(F.col(column).cast("bigint"), F.lit(LAST)).alias(key), hashed.alias(digest)]
    right = firsts.select(*named(id_column, F.col("text_hash"))).distinct()
    left = docs.select("*", *named(id_column, F.xxhash64(F.coalesce(F.col(text), F.lit("")))))
    # A rank of 1 is a group limit, which runs before the shuffle too.
    one = F.row_number().over(Window.partitionBy(key, digest).orderBy(F.lit(0)))
    single = left.withColumn(place, one).where(F.col(place) == 1)
    return single.join(right, [key, digest], "left_semi").select(*docs.columns)
