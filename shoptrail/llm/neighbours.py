"""Approximate nearest neighbours by NN-descent and greedy graph search.

A graph of near neighbours is built by local joins: a neighbour of a neighbour is likely a neighbour.
Each round gathers the vectors of every node's neighbours, compares them with each other inside the
node's row, and keeps each node's best. Queries then walk the graph greedily: a beam of the best nodes
found, whose unvisited neighbours are looked at next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from shoptrail.llm.common import cut_lineage

#: Neighbours kept per node, and as many reverse ones taken into a local join.
NEIGHBOURS = 32
REVERSE = 32
#: Building ends when a round changes less than this share of all entries.
LEAST_CHANGE = 0.02
#: Random divisions of space whose cells start the graph, and nodes that a cell's task compares at most.
ORDERS = 10
CELL = 3_000
#: Nodes a query keeps in view, and nodes whose neighbours it looks at in one step.
BEAM = 64
EXPAND = 16


def _parts(vector: str) -> Column:
    """Components in double precision; adding zero turns -0.0 to 0.0, so that equal vectors have one text."""
    return F.transform(F.col(vector), lambda x: x.cast("double") + F.lit(0.0).cast("double"))


def usable(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", ids: int = 6) -> DataFrame:
    """(node, ids, v): distinct vectors that are neither null, zero nor hold null or non-finite parts,
    divided by their length, in double precision.

    Equal vectors are one node, named by their smallest id. Only the k + 1 smallest ids of a node can be among
    the k nearest besides the query, so ``ids`` are kept; others are exact copies of them with larger
    ids. The limit is applied before the shuffle too, so a vector of a third of all rows stays harmless.
    """
    parts = _parts(vector)
    length = F.sqrt(F.aggregate("p", F.lit(0.0).cast("double"), lambda a, x: a + x * x))
    bad = F.exists("p", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    clean = (
        vectors.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull())
        .select(F.col(id_column).cast("bigint").alias("id"), parts.alias("p"))
        .where(~bad)
        .withColumn("length", length)
        .where("length > 0")
        .select("id", F.transform("p", lambda x: x / F.col("length")).alias("v"), F.col("p").alias("raw"))
    )
    key = F.unhex(F.md5(F.array_join(F.transform("raw", lambda x: x.cast("string")), ",")))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    few = clean.withColumn("key", key).withColumn("rank", rank).where(F.col("rank") <= ids)
    return few.groupBy("key").agg(F.min("id").alias("node"), F.array_sort(F.collect_list("id")).alias("ids"), F.first("raw").alias("v")).drop("key")


def _cells(directions: np.ndarray):
    """Cell of each vector in each way: on every level the nearest of that level's centres."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            m = np.stack(batch["v"].to_numpy())
            for way, levels in enumerate(directions):
                cell = np.zeros(len(m), np.int64)
                for centres in levels:
                    cell = cell * len(centres) + (m @ centres.T).argmax(axis=1)
                yield pd.DataFrame({"node": batch["node"], "way": way, "cell": cell, "v": batch["v"]})

    return run


def _inside(k: int):
    """Best ``k`` others of each node of one part of a cell, ``CELL`` nodes at most."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        ids, m, out = group["node"].to_numpy(), np.stack(group["v"].to_numpy()), []
        take = min(k, len(ids) - 1)
        for at in range(0, len(ids) if take > 0 else 0, 500):
            near = m[at : at + 500] @ m.T
            near[np.arange(len(near)), np.arange(at, at + len(near))] = -2
            best = np.argpartition(-near, take - 1, axis=1)[:, :take]
            out.append((np.repeat(ids[at : at + 500], take), ids[best].ravel(), np.take_along_axis(near, best, 1).ravel()))
        parts = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0)] * 3
        return pd.DataFrame({"node": parts[0].astype("int64"), "other": parts[1].astype("int64"), "near": parts[2].astype("float64")})

    return run


def _start(nodes: DataFrame, total: int, k: int, seed: int) -> DataFrame:
    """First edges (node, other, near): in several random divisions of space into cells, each node's best
    inside its cell.

    A division has levels of up to 32 centres, as many as it takes for cells of about ``CELL`` / 2 nodes; centres
    are a fixed number of the vectors. A cell that is fuller is dealt into parts by digest.
    """
    fan = int(min(32, max(1, total // (CELL // 2))))
    levels = 1
    while fan > 1 and fan**levels < total // CELL:
        levels += 1
    wanted = ORDERS * levels * fan
    picked = nodes.orderBy(F.xxhash64("node", F.lit(seed)), "node").limit(wanted).collect()
    centres = np.asarray([row["v"] for row in picked], np.float32)
    centres = centres[np.arange(wanted) % len(centres)].reshape(ORDERS, levels, fan, -1)
    celled = nodes.mapInPandas(_cells(centres), "node bigint, way int, cell bigint, v array<float>")
    # One row per way and cell.
    sizes = celled.groupBy("way", "cell").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64("node", "way"), F.ceil(F.col("n") / CELL))
    dealt = celled.join(sizes, ["way", "cell"]).withColumn("part", part)
    return dealt.groupBy("way", "cell", "part").applyInPandas(_inside(k), "node bigint, other bigint, near double")


def _local_join(k: int):
    """Inside a node's row all its neighbours are compared with each other and with the node. A pair
    is a candidate if one of the two came new in the last round, and for those of the two that have
    nothing better on their list yet."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            for others, fresh, worst, vectors in zip(batch["others"], batch["fresh"], batch["worst"], batch["vectors"]):
                ids, m, new = np.asarray(others), np.stack(vectors), np.asarray(fresh)
                near = m @ m.T
                near[~(new[:, None] | new[None, :])] = -2
                np.fill_diagonal(near, -2)
                take = min(k, len(ids) - 1)
                if take < 1:
                    continue
                best = np.argpartition(-near, take - 1, axis=1)[:, :take]
                value = np.take_along_axis(near, best, 1)
                i, j = np.nonzero(value > np.asarray(worst, np.float32)[:, None])
                out[0].append(ids[i])
                out[1].append(ids[best[i, j]])
                out[2].append(value[i, j])
            if out[0]:
                # Of what the batch found several times one row goes on.
                found = pd.DataFrame({"node": np.concatenate(out[0]), "other": np.concatenate(out[1]), "near": np.concatenate(out[2]).astype("float64")})
                yield found.drop_duplicates(["node", "other"])

    return run


def _top(edges: DataFrame, node: str, by: list[Column], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(node).orderBy(*by))
    return edges.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def build_graph(nodes: DataFrame, k: int = NEIGHBOURS, seed: int = 5) -> DataFrame:
    """(node, other, near): the ``k`` nearest others of each node, as far as descent has found them.

    ``nodes`` is (node, v) with unit vectors of floats. A round joins each node with its forward neighbours
    and the nearest of its reverse ones, so no hub gathers more than ``NEIGHBOURS`` + ``REVERSE`` vectors. What was
    compared in earlier rounds is not compared again.
    """
    total = nodes.count()
    if total < 2:
        return nodes.select("node", F.col("node").alias("other"), F.lit(1.0).alias("near")).limit(0)
    best_first = [F.desc("near"), F.col("other")]
    start = _start(nodes, total, k, seed).groupBy("node", "other").agg(F.max("near").alias("near"))
    graph = cut_lineage(_top(start, "node", best_first, k).withColumn("new", F.lit(True)))
    while True:
        back = graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "near", "new")
        back = _top(back, "node", best_first, REVERSE)
        around = graph.unionByName(back).groupBy("node", "other").agg(F.max("new").alias("new"))
        around = around.unionByName(nodes.select("node", F.col("node").alias("other"), F.lit(False).alias("new")))
        last = graph.groupBy("node").agg(F.when(F.count("*") == k, F.min("near")).otherwise(F.lit(-1.5)).alias("worst"))
        named = nodes.join(last, "node", "left").select(
            F.col("node").alias("other"), F.col("v").alias("w"), F.coalesce("worst", F.lit(-1.5)).alias("worst")
        )
        gathered = (
            around.join(named, "other")
            .groupBy("node")
            .agg(F.collect_list(F.struct("other", "new", "worst", "w")).alias("all"))
            .select(F.col("all.other").alias("others"), F.col("all.new").alias("fresh"), F.col("all.worst").alias("worst"), F.col("all.w").alias("vectors"))
        )
        found = gathered.mapInPandas(_local_join(k), "node bigint, other bigint, near double").withColumn("new", F.lit(True))
        old = graph.withColumn("new", F.lit(False))
        both = found.unionByName(old).groupBy("node", "other").agg(F.max("near").alias("near"), F.min("new").alias("new"))
        graph = cut_lineage(_top(both, "node", best_first, k))
        changed = graph.agg(F.count_if("new"), F.count("*")).first()
        # Entries only get better, so changes end; with fewer than LEAST_CHANGE of them another round gains little.
        if changed[0] <= LEAST_CHANGE * changed[1]:
            return graph.select("node", "other", "near")


def search(queries: DataFrame, nodes: DataFrame, graph: DataFrame, beam: int = BEAM) -> DataFrame:
    """(query, node, near): the ``beam`` nearest nodes that a greedy walk from the query's own node finds.

    ``queries`` is (query, v, node); each step looks at the neighbours, forward and reverse, of the best nodes
    of the beam that were not looked at, and ends when no query has any left.
    """
    back = _top(graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "near"), "node", [F.desc("near"), F.col("other")], REVERSE)
    links = cut_lineage(graph.select("node", "other").unionByName(back.select("node", "other")).distinct())
    named = nodes.select("node", F.col("v").alias("w"))
    dot = F.aggregate(F.zip_with("q", "w", lambda a, b: a * b), F.lit(0.0).cast("double"), lambda a, x: a + x)
    asked = queries.select("query", F.col("v").alias("q"))
    view = cut_lineage(queries.select("query", "node", F.lit(1.0).cast("double").alias("near"), F.lit(False).alias("seen")))
    while True:
        ahead = _top(view.where("not seen"), "query", [F.desc("near"), F.col("node")], EXPAND)
        fresh = (
            ahead.select("query", "node").join(links, "node").select("query", F.col("other").alias("node")).distinct()
            .join(view.select("query", "node"), ["query", "node"], "left_anti")
        )
        scored = fresh.join(asked, "query").join(named, "node").select("query", "node", dot.alias("near"), F.lit(False).alias("seen"))
        marked = view.join(ahead.select("query", "node", F.lit(True).alias("now")), ["query", "node"], "left").select(
            "query", "node", "near", (F.col("seen") | F.coalesce("now", F.lit(False))).alias("seen")
        )
        view = cut_lineage(_top(marked.unionByName(scored), "query", [F.desc("near"), F.col("node")], beam))
        if view.where("not seen").isEmpty():
            return view.select("query", "node", "near")


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest by cosine of each row whose id is divisible by
    ``every``, besides itself; ties go to the smaller id, and with fewer candidates all come.

    Rows whose id is null, or whose vector is null, empty, zero or not finite, take no part. Of rows that
    repeat an id and vector each is a candidate of its own. Scores are computed on the original vectors.
    """
    nodes = cut_lineage(usable(vectors, id_column, vector, k + 1))
    unit = F.transform("v", lambda x: x / F.sqrt(F.aggregate("v", F.lit(0.0).cast("double"), lambda a, y: a + y * y)))
    normal = cut_lineage(nodes.select("node", unit.alias("v")))
    graph = build_graph(normal.select("node", F.col("v").cast("array<float>").alias("v")))
    # Every copy of a vector that is asked for is a query: more than the six ids a node keeps.
    raw = vectors.where((F.col(id_column) % every == 0) & F.col(vector).isNotNull()).select(
        F.col(id_column).cast("bigint").alias("query"), _parts(vector).alias("raw")
    ).distinct()
    queries = cut_lineage(
        raw.join(nodes.select("node", F.col("v").alias("raw")), "raw").join(normal, "node").select("query", "node", "v", "raw")
    )
    found = search(queries.select(F.col("node").alias("query"), "node", "v").distinct(), normal, graph)
    pairs = found.withColumnsRenamed({"query": "asked"}).join(queries.select("query", F.col("node").alias("asked"), "raw"), "asked")
    pairs = pairs.join(nodes.select("node", "ids", F.col("v").alias("w")), "node")
    product = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"), lambda s, x: s + x)
    score = product("raw", "w") / (F.sqrt(product("raw", "raw")) * F.sqrt(product("w", "w")))
    rows = pairs.select("query", score.alias("score"), F.explode("ids").alias("vec_id")).where("query != vec_id")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
