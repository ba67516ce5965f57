"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is met in three steps: whole rounds of all its documents, then for the remaining
budget a number of documents of each exact length, found by bounded-knapsack dynamic programming over
the counts of lengths, and last the choice of as many documents of that length by a seeded digest.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from shoptrail.llm.common import cut_lineage, free_name, word_count

WEIGHTS = (5, 2, 1)
#: A source gives at most this many times its size.
MOST_ROUNDS = 3
#: The exact fitting works on budgets up to this many words; what is above is taken evenly from all
#: lengths first.
EXACT_BUDGET = 1 << 16
#: Documents of one source and length are counted and ranked in this many parts.
PARTS = 1024


def targets(sizes: DataFrame, total: Column | None = None) -> DataFrame:
    """(source, source_size) to (source, source_size, target), one row per source.

    Weights 5, 2, 1 repeat over the sources in code point order, null last. All sizes together are
    shared by weight; a source's target stops at 3 times its size, and the excess goes to the others
    by weight until none is above. That is target = min(3 size, level * weight) for one level: with
    sources in order of size / weight, those that stop come first, and the level follows from running
    sums. Only the one row per source is ordered in one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.lit(list(WEIGHTS)).cast("array<double>"), (place % len(WEIGHTS) + 1).cast("int"))
    weighed = sizes.withColumn("weight", weight)
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, rest = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    most = F.lit(float(MOST_ROUNDS)) * F.col("source_size")
    level = (
        F.sum("source_size").over(everything).cast("double")
        - F.coalesce(F.sum(most).over(earlier), F.lit(0.0))
    ) / F.sum("weight").over(rest)
    stops = weighed.withColumn("level", level).withColumn("stops", F.col("level") * F.col("weight") > most)
    # The first source that does not stop sets the level of all from there on.
    common = F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), "level"))).over(everything)
    shared = stops.withColumn("common", common["level"])
    return shared.select(
        "source",
        "source_size",
        F.least(most, F.coalesce("common", "level") * F.col("weight")).alias("target"),
    )


def fit_lengths(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their words sum up to ``budget`` or as
    little below it as can be reached.

    An even share of every length goes first, then single documents, longest first, until the rest
    is below ``EXACT_BUDGET``. The rest is fitted exactly: bit ``b`` of ``reach[i]`` says that sizes
    1..i can sum to b, with counts in binary pieces (bounded knapsack).
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if total <= budget:
        return list(counts)
    above = max(0, budget - EXACT_BUDGET // 2)
    taken = [c * above // total for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, taken))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:
        if left < EXACT_BUDGET:
            break
        more = min(counts[i] - taken[i], max(0, left - EXACT_BUDGET // 2) // lengths[i], 1)
        taken[i] += more
        left -= more * lengths[i]
    for i in order:  # should single documents not have been enough
        if left < EXACT_BUDGET:
            break
        more = min(counts[i] - taken[i], (left - EXACT_BUDGET // 2) // lengths[i])
        taken[i] += more
        left -= more * lengths[i]
    pieces, reach, full = [], [1], (1 << left + 1) - 1
    for i in order:
        if lengths[i] > left:
            continue
        some, piece = min(counts[i] - taken[i], left // lengths[i]), 1
        while some > 0:
            piece = min(piece, some)
            pieces.append((i, piece))
            reach.append((reach[-1] | reach[-1] << piece * lengths[i]) & full)
            some -= piece
            piece *= 2
        if reach[-1] >> left:
            break
    at = reach[-1].bit_length() - 1
    for step in range(len(pieces), 0, -1):
        if not reach[step - 1] >> at & 1:
            i, piece = pieces[step - 1]
            taken[i] += piece
            at -= piece * lengths[i]
    return taken


def _fit_source(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """All rows of one source, one per length: as many as the longest document has words, at most."""
    target, size = group["target"].iloc[0], int(group["source_size"].iloc[0])
    group = group[group["size"] > 0].sort_values("size")
    rounds = min(MOST_ROUNDS, int(target // size)) if size else 0
    lengths, counts = [int(x) for x in group["size"]], [int(x) for x in group["n"]]
    budget = round(target - rounds * size) if rounds < MOST_ROUNDS else 0
    taken = fit_lengths(lengths, counts, budget)
    return pd.DataFrame(
        {"source_key": group["source_key"], "size": group["size"], "rounds": rounds, "extra": taken}
    )


def mix(docs: DataFrame, seed: int = 42, text: str = "text", source: str = "source", id_column: str = "doc_id") -> DataFrame:
    """One row per document: (doc_id, size, source_size, target, taken), ``taken`` in words.

    Sizes are counts of words; a null or empty text has none and is never taken. Null sources are a
    source of their own, the last. Ties in the seeded digest go to the smaller id, null last, then to the
    smaller digest of the text; repeated rows are documents of their own. Only narrow rows are shuffled.
    """
    chosen = _chosen(docs, seed, text, source, id_column)
    return chosen.select(
        F.col("id").alias(id_column), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def repeated(docs: DataFrame, seed: int = 42, text: str = "text", source: str = "source", id_column: str = "doc_id") -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it; those it does not take are left out.

    Documents without words (size 0) stay once. Texts are shuffled once, to meet their number of copies;
    rows that repeat id, source and text share the copies of all of them evenly.
    """
    key = {name: free_name(docs, name) for name in ("id", "null", "hash", "source")}
    total, rows_of, place, copy = (free_name(docs, name) for name in ("total", "rows", "place", "copy"))

    def named(of: str, hashed: Column, source_of: Column) -> list[Column]:
        found = (F.coalesce(F.col(of).cast("string"), F.lit("")), F.col(of).isNull(), hashed, source_of)
        return [column.alias(name) for column, name in zip(found, key.values())]

    chosen = _chosen(docs, seed, text, source, id_column)
    taken = (
        chosen.select(*named("id", F.col("text_hash"), F.col("source_key")), F.when(F.col("size") == 0, 1).otherwise(F.col("copies")).alias("n"))
        .groupBy(*key.values())
        .agg(F.sum("n").alias(total), F.count("*").alias(rows_of))
    )
    met = docs.select("*", *named(id_column, _text_hash(text), _source_key(source))).join(taken, list(key.values()))
    number = F.row_number().over(Window.partitionBy(*key.values()).orderBy(F.lit(0)))
    copies = F.expr(f"`{total}` DIV `{rows_of}`").cast("int") + (F.col(place) <= F.col(total) % F.col(rows_of)).cast("int")
    opened = met.withColumn(place, number).withColumn(copy, copies).where(F.col(copy) > 0)
    return opened.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*docs.columns)


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _source_key(source: str) -> Column:
    return F.when(F.col(source).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(source).cast("string")))


def _chosen(docs: DataFrame, seed: int, text: str, source: str, id_column: str) -> DataFrame:
    """(id, text_hash, source_key, size, source_size, target, copies) of each document.

    Documents of one source and length are dealt over 1,024 parts by digest and counted there. Parts are
    taken whole in order, so at most one part of each length has to be ranked.
    """
    digest = F.xxhash64(F.lit(seed), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    narrow = docs.select(
        F.col(id_column).alias("id"), F.col(source).cast("string").alias("source"), _source_key(source).alias("source_key"),
        word_count(F.col(text)).alias("size"), digest.alias("digest"), _text_hash(text).alias("text_hash"),
    )
    narrow = cut_lineage(narrow.withColumn("part", F.pmod("digest", F.lit(PARTS)).cast("int")))
    cells = cut_lineage(narrow.groupBy("source", "source_key", "size", "part").agg(F.count("*").alias("n")))
    lengths = cells.groupBy("source", "source_key", "size").agg(F.sum("n").alias("n"))
    sizes = lengths.groupBy("source", "source_key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    keyed = sizes.select("source", "source_key").join(
        targets(sizes.drop("source_key")).withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))
    )
    goals = cut_lineage(keyed.select("source_key", "source_size", "target"))
    fitted = (
        lengths.select("source_key", "size", "n")
        .join(goals, "source_key")
        .groupBy("source_key")
        .applyInPandas(_fit_source, "source_key string, size bigint, rounds bigint, extra bigint")
    )
    in_order = Window.partitionBy("source_key", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(in_order), F.lit(0))
    plan = cells.join(fitted, ["source_key", "size"], "left").select(
        "source_key", "size", "part", "n", F.coalesce("rounds", F.lit(0)).alias("rounds"),
        F.least(F.greatest(F.coalesce("extra", F.lit(0)) - before, F.lit(0)), F.col("n")).alias("some"),
    )
    planned = narrow.drop("source").join(plan, ["source_key", "size", "part"])
    whole = planned.where("some = 0 or some = n").withColumn("one_more", F.col("some") > 0)
    ranked = Window.partitionBy("source_key", "size", "part").orderBy("digest", F.col("id").asc_nulls_last(), "text_hash")
    cut = planned.where("some > 0 and some < n").withColumn("one_more", F.row_number().over(ranked) <= F.col("some"))
    chosen = whole.unionByName(cut)
    copies = F.col("rounds") + F.col("one_more").cast("bigint")
    # One row per source.
    return chosen.join(goals, "source_key").select(
        "id", "text_hash", "source_key", "size", "source_size", "target", copies.alias("copies")
    )
