"""Hard-negative mining by threshold joins with suffix-norm bounds.

An anchor's positives are its nearest rows of the same label; its hard negatives are the nearest rows of other labels
whose score lies in a window below each positive's. Both come from threshold joins: all pairs of an anchor
and a row whose inner product reaches the anchor's threshold. Thresholds start high and are lowered only for
anchors whose windows are not full yet.

Anchors meet rows in blocks. A block keeps an inverted index by dimension, most energy first. A row stands in the
lists of its leading dimensions only: the rest is left out as soon as the norm of what remains, times the largest norm
of the anchors, can't reach the lowest threshold. Partial scores are accumulated list by list; a pair goes as
soon as its partial score and the product of both remaining norms stay below the threshold; what survives is
scored exactly in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shoptrail.llm.common import cut_lineage

#: Rows and anchors that one task compares at a time.
ROWS, ANCHORS = 4_096, 1_024
#: Dimensions that are accumulated between two looks at the bounds.
DIMENSIONS = 8
#: Cells that rows are dealt into; their centres are that many of the vectors.
MOST_CELLS = 1_024
#: Thresholds of the search for positives as shares of the anchor's squared norm; the last round has none.
POSITIVE_STEPS = (0.6, 0.3, None)
#: Thresholds of the search for negatives as shares of the positive's score, down to the window's lower end.
NEGATIVE_STEPS = (0.9, 0.8)
#: Fixed values of the windows.
POSITIVES, NEGATIVES, LOWEST_PERCENT = 5, 5, 80
SCALE = 256
#: Integers up to this stay exact as doubles.
_EXACT = float(1 << 53)
_BIGGEST = (1 << 63) - 1


def usable(vectors: DataFrame, id_column: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """(id, label, v): rows with an id and a label whose vector is not null and all finite; v holds floor(256 x)."""
    parts = F.transform(F.col(vector), lambda x: x.cast("double"))
    bad = F.exists("p", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    clean = vectors.where(F.col(id_column).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull())
    return (
        clean.select(F.col(id_column).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), parts.alias("p"))
        .where(~bad)
        .select("id", "label", F.transform("p", lambda x: F.floor(x * F.lit(float(SCALE)))).alias("v"))
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def exact_scores(left: pd.Series, right: pd.Series, i: np.ndarray, j: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Integer inner products of the pairs (left[i], right[j]), in slices; ``m`` and ``n`` hold the same as doubles.
    Beyond 2^53 Python's integers take over, and results beyond 64 bits are cut to the largest."""
    biggest = (np.abs(m).max(initial=0) * np.abs(n).max(initial=0)) * max(1, m.shape[1])
    if biggest < _EXACT:
        parts = [np.einsum("ij,ij->i", m[i[at : at + 50_000]], n[j[at : at + 50_000]]) for at in range(0, len(i), 50_000)]
        return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    a, b = left.to_numpy(), right.to_numpy()
    sums = (sum(int(x) * int(y) for x, y in zip(a[p], b[q])) for p, q in zip(i, j))
    return np.fromiter((max(-_BIGGEST, min(_BIGGEST, s)) for s in sums), np.int64, len(i))


def survivors(q: np.ndarray, x: np.ndarray, threshold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of ``q``, row of ``x``) that may reach ``threshold`` (one number per row of ``q``); none that does is left out.

    ``x`` is indexed by dimension. Rows are sorted by how many leading dimensions they are indexed under, so a
    dimension's list is the first part of the rows.
    """
    order = np.argsort(-(x * x).sum(axis=0), kind="stable")
    q, x = q[:, order], x[:, order]
    edges = [*range(0, x.shape[1], DIMENSIONS), x.shape[1]]
    tail = lambda m: np.sqrt(np.stack([(m[:, e:] ** 2).sum(axis=1) for e in edges], axis=1)) * (1 + 1e-9)
    q_tail, x_tail = tail(q), tail(x)
    lowest, largest = threshold.min(), q_tail[:, 0].max()
    # Dimensions behind edge k are left out of a row's index if their norm alone can't reach the lowest threshold.
    indexed = (x_tail * largest >= lowest).sum(axis=1) if lowest > 0 else np.full(len(x), len(edges))
    rows = np.argsort(-indexed, kind="stable")
    rows = rows[indexed[rows] > 0]
    x, x_tail, indexed = x[rows], x_tail[rows], indexed[rows]
    slack = 1e-6 * (1 + np.abs(threshold))[:, None]
    score = np.zeros((len(q), len(rows)))
    for k, (begin, end) in enumerate(zip(edges, edges[1:])):
        listed = int(np.searchsorted(-indexed, -(k + 1), side="right"))
        if listed == 0:
            break
        score[:, :listed] += q[:, begin:end] @ x[:listed, begin:end].T
        if k % 2 and lowest > 0:  # rows that no anchor can reach any more leave the index
            alive = (score + q_tail[:, [k + 1]] * x_tail[None, :, k + 1] + slack >= threshold[:, None])
            alive[:, listed:] = True
            alive = alive.any(axis=0)
            if alive.mean() < 0.7:
                score, x, x_tail, indexed, rows = score[:, alive], x[alive], x_tail[alive], indexed[alive], rows[alive]
    # What is not accumulated of a pair is bounded by the norms behind the row's last indexed edge.
    last = np.minimum(indexed, len(edges) - 1)
    rest = q_tail[:, last] * x_tail[np.arange(len(x)), last][None, :]
    i, j = np.nonzero(score + rest + slack >= threshold[:, None])
    return i, rows[j]


_HITS = "anchor_id bigint, anchor bigint, window bigint, id bigint, score bigint"


def _join(negatives: bool):
    """First rows of each window of each anchor among the rows of one block; all of a tie are looked at."""

    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(rows) and len(anchors):
            width = max(1, rows["v"].map(len).max(), anchors["v"].map(len).max())
            x, q = _matrix(rows["v"], width), _matrix(anchors["v"], width)
            low, below = anchors["threshold"].to_numpy(np.float64), anchors["below"].to_numpy(np.float64)
            i, j = survivors(q, x, low)
            score = exact_scores(anchors["v"], rows["v"], i, j, q, x)
            fits = (score >= low[i]) & (score < below[i])
            order = np.lexsort((-score[fits], i[fits]))
            i, j, score = i[fits][order], j[fits][order], score[fits][order]
            begins = np.searchsorted(i, np.arange(len(anchors) + 1))
            entries = rows["entries"].to_numpy()
            for a, (own, name, label, windows) in enumerate(zip(anchors["anchor_id"], anchors["anchor"], anchors["label"], anchors["windows"])):
                mine, near = score[begins[a] : begins[a + 1]], j[begins[a] : begins[a + 1]]
                for window in windows:
                    at, last = 0, None
                    if negatives:
                        at, last = int(np.searchsorted(-mine, -window)), -(-LOWEST_PERCENT * int(window) // 100)
                    left: list[tuple[int, int]] = []
                    for k in range(at, len(mine)):
                        s = int(mine[k])
                        if (last is not None and s < last) or (len(left) >= NEGATIVES and -left[-1][0] != s):
                            break
                        left += [(-s, e["id"]) for e in entries[near[k]] if e["id"] != own and (e["label"] == label) != negatives]
                    found += [(own, name, window, key, -s) for s, key in sorted(left)[:NEGATIVES]]
        columns = ["anchor_id", "anchor", "window", "id", "score"]
        return pd.DataFrame(found, columns=columns).astype("int64")

    return run


def _deal_rows(centres: np.ndarray):
    """Cell of each vector, the nearest centre, and its distance from that centre."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                part = batch.iloc[at : at + ROWS]
                width = max([centres.shape[1], *map(len, part["v"])])
                m, c = _matrix(part["v"], width), np.zeros((len(centres), width))
                c[:, : centres.shape[1]] = centres
                far = (m * m).sum(axis=1)[:, None] - 2 * m @ c.T + (c * c).sum(axis=1)[None, :]
                cell = far.argmin(axis=1)
                distance = np.sqrt(((m - c[cell]) ** 2).sum(axis=1)) * (1 + 1e-9)
                yield part.assign(cell=cell.astype("int32"), distance=distance)

    return run


def _deal_anchors(sent):
    """Cells whose rows an anchor has to meet: q . centre + |q| * radius reaches its threshold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, cells, radius = sent.value
        for batch in batches:
            for at in range(0, len(batch), ANCHORS):
                part = batch.iloc[at : at + ANCHORS]
                width = max([centres.shape[1], *map(len, part["v"])])
                q, c = _matrix(part["v"], width), np.zeros((len(centres), width))
                c[:, : centres.shape[1]] = centres
                reach = (q @ c.T)[:, cells] + np.sqrt((q * q).sum(axis=1))[:, None] * radius[None, :]
                i, j = np.nonzero(reach + 1e-6 * (1 + np.abs(reach)) >= part["threshold"].to_numpy(np.float64)[:, None])
                yield part.iloc[i].assign(cell=cells[j].astype("int32"))

    return run


class Rows:
    """Distinct vectors, dealt into cells around at most ``MOST_CELLS`` of them; the driver keeps centres and radii.

    Columns: (group, v, entries). Only anchors of the same ``group`` meet a row. ``entries`` are the (id, label) of the rows
    that have the vector, as many of the smallest ids as can count.
    """

    def __init__(self, rows: DataFrame, seed: int = 3):
        self.spark = rows.sparkSession
        wanted = max(1, min(MOST_CELLS, rows.count() // ROWS))
        picked = rows.orderBy(F.xxhash64("v", F.lit(seed)), "v").select("v").limit(wanted).collect()
        centres = pd.Series([r["v"] for r in picked], dtype=object)
        self.centres = _matrix(centres, max([1, *map(len, centres)])) if len(centres) else np.zeros((1, 1))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        dealt = cut_lineage(rows.mapInPandas(_deal_rows(self.centres), f"{fields}, cell int, distance double"))
        summary = dealt.groupBy("cell").agg(F.max("distance").alias("radius")).collect()
        self.cells = np.asarray([r["cell"] for r in summary], np.int64)
        self.radius = np.asarray([r["radius"] for r in summary], np.float64)
        self.rows = dealt.drop("distance")
        self.sizes = cut_lineage(dealt.groupBy("group", "cell").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("parts")))

    def join(self, anchors: DataFrame, negatives: bool) -> DataFrame:
        """(anchor_id, anchor, window, id, score): rows with ``threshold`` <= score < ``below``, of each window at least the first.

        ``anchors`` is (anchor_id, anchor, label, group, v, threshold, below, windows). Both sides are dealt by digest into
        parts of bounded size, and each part of a cell's rows meets each part of the anchors that may reach it: a
        stated query set against blocks of all rows. Only rows that anchors ask for are moved.
        """
        sent = self.spark.sparkContext.broadcast((self.centres, self.cells, self.radius))
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in anchors.schema)
        reach = cut_lineage(anchors.mapInPandas(_deal_anchors(sent), f"{fields}, cell int"))
        turns = reach.groupBy("group", "cell").agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("turns"))
        blocks = self.sizes.join(turns, ["group", "cell"])
        part = lambda n, *names: F.pmod(F.xxhash64(*names, F.lit(17)), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = self.rows.join(blocks, ["group", "cell"]).select("group", "cell", "v", "entries", part("parts", "v").alias("part"), every("turns").alias("turn"))
        right = reach.join(blocks, ["group", "cell"]).select(
            *reach.columns, part("turns", "anchor_id", "anchor").alias("turn"), every("parts").alias("part")
        )
        keys = ["group", "cell", "part", "turn"]
        return cut_lineage(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_join(negatives), _HITS))


def _first(hits: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of each window: highest score, then smallest id."""
    order = Window.partitionBy("anchor_id", "anchor", "window").orderBy(F.desc("score"), "id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _counted(hits: DataFrame) -> DataFrame:
    return hits.groupBy("anchor_id", "anchor", "window").agg(F.count("*").alias("n"))


def find_positives(rows: Rows, anchors: DataFrame, n: int = POSITIVES) -> DataFrame:
    """(anchor_id, anchor, window, id, score, rank): the first ``n`` of the anchor's group.

    All pairs above an anchor's threshold are known after a round, so an anchor that has ``n`` of them is done; for the
    others the threshold is lowered, at last to none.
    """
    norm = F.aggregate("v", F.lit(0.0).cast("double"), lambda total, x: total + x * x.cast("double"))
    left = cut_lineage(anchors.withColumns({"norm": norm, "below": F.lit(float("inf")), "windows": F.array(F.lit(0).cast("bigint"))}))
    found = None
    for step in POSITIVE_STEPS:
        threshold = F.lit(float("-inf")) if step is None else F.least(F.col("norm") * step, F.col("below"))
        asked = left.withColumn("threshold", threshold)
        hits = rows.join(asked.drop("norm"), negatives=False)
        found = hits if found is None else found.unionByName(hits)
        done = _counted(found).where(F.col("n") >= n)
        left = cut_lineage(asked.join(done, ["anchor_id", "anchor"], "left_anti").withColumn("below", F.col("threshold")).drop("threshold"))
        if step is None or left.isEmpty():
            break
    return _first(found, n)


def find_negatives(rows: Rows, anchors: DataFrame, positives: DataFrame, n: int = NEGATIVES) -> DataFrame:
    """(anchor_id, anchor, window, id, score, rank): of the rows with other labels the first ``n`` of each window, that is
    with LOWEST_PERCENT * window <= 100 * score <= 100 * window. A window is a positive's score."""
    keys = ["anchor_id", "anchor"]
    # Below zero the window's lower end is above its upper one.
    left = cut_lineage(positives.where("score >= 0").select(*keys, F.col("score").alias("window")).distinct())
    below, found = anchors.select(*keys, F.lit(float("inf")).alias("below")), None
    for step in NEGATIVE_STEPS:
        windows = left.groupBy(*keys).agg(F.collect_list("window").alias("windows"))
        least = F.array_min("windows") * F.lit(float(step)) - 0.5
        asked = cut_lineage(anchors.join(windows.join(below, keys), keys).withColumn("threshold", F.least(least, F.col("below"))))
        hits = rows.join(asked, negatives=True)
        found = hits if found is None else found.unionByName(hits)
        below = asked.select(*keys, F.col("threshold").alias("below"))
        full = _counted(found).where(F.col("n") >= n)
        left = cut_lineage(left.join(full, [*keys, "window"], "left_anti"))
        if left.isEmpty():
            break
    return _first(found, n)


def mine(
    vectors: DataFrame, every: int = 100, id_column: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose id is divisible by ``every``. Rows with a null id, label or vector, or with a null or non-finite
    component, take no part. Scores are inner products of floor(256 x); shorter vectors end in zeros, an empty one
    scores 0. Rows that repeat id, label and vector count once, and rows of the anchor's own id never count for it.
    Ties go to the smaller id. Anchors without positives or without rows in a window give no rows.
    """
    clean = usable(vectors, id_column, label, vector)
    place = F.dense_rank().over(Window.partitionBy("v", "label").orderBy("id"))
    few = clean.withColumn("place", place).where(F.col("place") <= POSITIVES + 1)
    few = cut_lineage(few.groupBy("v", "label").agg(F.array_sort(F.collect_set("id")).alias("ids")))
    named = few.withColumn("entries", F.transform("ids", lambda i: F.struct(i.alias("id"), F.col("label").alias("label"))))
    same = Rows(named.select(F.col("label").alias("group"), "v", "entries"))
    # Of the first 12 ids at most 6 are of the anchor's label, and one of the others may be its own.
    both = 2 * (NEGATIVES + 1)
    order = F.row_number().over(Window.partitionBy("v").orderBy("e.id", "e.label"))
    listed = named.select("v", F.explode("entries").alias("e")).withColumn("place", order).where(F.col("place") <= both)
    other = Rows(listed.groupBy("v").agg(F.sort_array(F.collect_list("e")).alias("entries")).select(F.lit(0).cast("bigint").alias("group"), "v", "entries"))
    anchors = cut_lineage(
        clean.where(F.col("id") % every == 0).distinct().select(
            F.col("id").alias("anchor_id"), F.xxhash64("id", "label", "v").alias("anchor"), "label", F.col("label").alias("group"), "v"
        )
    )
    positives = cut_lineage(find_positives(same, anchors))
    negatives = find_negatives(other, anchors.withColumn("group", F.lit(0).cast("bigint")), positives)
    pairs = positives.select("anchor_id", "anchor", F.col("id").alias("positive_id"), F.col("score").alias("window"))
    return pairs.join(negatives, ["anchor_id", "anchor", "window"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        F.col("window").alias("positive_score"), F.col("score").alias("negative_score"),
    )
