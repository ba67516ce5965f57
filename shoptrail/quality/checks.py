"""Check algebra: profile tables into facts, then judge facts.

A fact is a number about one table, named ``table.fact``. All row facts of a table come from one
aggregate that shuffles a single row per task; facts about a key come from one grouped count, added
up before it shuffles. A check is an SQL expression over facts giving the number of violations, so
comparing layers needs no join: the facts a run of checks mentions are computed once each, put side
by side in one row, and every check is evaluated on that row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, functions as F

PASS, FAIL, WARN = "PASS", "FAIL", "WARN"
RESULT = "suite string, check string, violations bigint, status string"
_FACT = re.compile(r"\b([a-z_]+)\.([a-z_]+)\b")


def blank(column: str) -> str:
    """SQL condition: NULL or only white space."""
    return rf"({column} IS NULL OR {column} RLIKE '^\\s*$')"


def rows_where(condition: str) -> str:
    """Aggregate: rows that meet a condition (a NULL condition is not met)."""
    return f"count_if({condition})"


# Facts about the non-NULL values of a key column, over one row (value, n) per value.
KEY_FACTS = {
    "values": "count(*)",
    "filled": "count_if(NOT {blank})",
    "repeats": "coalesce(sum(n - 1), 0)",
    "repeated": "count_if(n > 1)",
}


@dataclass(frozen=True)
class Profile:
    """What can be said about a table: aggregates by fact name, and keys.

    Each key offers facts ``<key>_values`` (distinct values), ``<key>_filled`` (those not blank),
    ``<key>_repeats`` (rows past the first of each value) and ``<key>_repeated`` (values with more
    than one row).
    """

    facts: dict[str, str]
    keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()


@dataclass(frozen=True)
class Suite:
    """Checks by name; those in ``warn`` report but do not fail. ``table`` owns the suite."""

    table: str
    checks: dict[str, str]
    warn: tuple[str, ...] = field(default=())

    def mentioned(self) -> set[tuple[str, str]]:
        return {pair for sql in self.checks.values() for pair in _FACT.findall(sql)}

    def tables(self) -> list[str]:
        return sorted({table for table, _ in self.mentioned()} | {self.table})


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _named(one_row: DataFrame, table: str) -> DataFrame:
    """One row of numbers to (fact, value) rows."""
    numbers = one_row.select(
        *[F.col(name).cast("double").alias(f"{table}.{name}") for name in one_row.columns]
    )
    return numbers.unpivot([], [F.col(f"`{name}`") for name in numbers.columns], "fact", "value")


def profile(table: str, df: DataFrame, about: Profile, wanted: set[str]) -> list[DataFrame]:
    """(fact, value) frames holding the wanted facts of one table."""
    frames = []
    plain = {name: sql for name, sql in about.facts.items() if name in wanted}
    if plain:
        frames.append(_named(df.agg(*[F.expr(sql).alias(name) for name, sql in plain.items()]), table))
    for key in about.keys:
        asked = {what: sql for what, sql in KEY_FACTS.items() if f"{key}_{what}" in wanted}
        if asked:
            counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
            measures = [
                F.expr(sql.format(blank=blank(key))).alias(f"{key}_{what}") for what, sql in asked.items()
            ]
            frames.append(_named(counts.agg(*measures), table))
    return frames


def missing_columns(df: DataFrame, required) -> list[str]:
    return [name for name in required if name not in df.columns]


def _side_by_side(frames: list[DataFrame], names: list[str]) -> DataFrame:
    picked = [F.max(F.when(F.col("fact") == name, F.col("value"))).alias(name) for name in names]
    return union_all(frames).agg(*picked)


def evaluate(
    suites: dict[str, Suite], tables: dict[str, DataFrame], profiles: dict[str, Profile],
    **parameters: float,
) -> DataFrame:
    """(suite, check, violations, status) for every check of every suite.

    A suite one of whose tables lacks required columns reports just that. ``parameters`` fill in
    ``{name}`` in check expressions.
    """
    lacking = {
        table: len(missing_columns(tables[table], profiles[table].required))
        for suite in suites.values() for table in suite.tables()
    }
    sound = {n: s for n, s in suites.items() if not any(lacking[t] for t in s.tables())}
    spark = next(iter(tables.values())).sparkSession
    refused = [
        (name, "required_columns", sum(lacking[t] for t in suite.tables()), FAIL)
        for name, suite in suites.items() if name not in sound
    ]
    results = [spark.createDataFrame(refused, RESULT)] if refused else []
    if sound:
        results.append(_judge(sound, tables, profiles, parameters))
    return union_all(results)


def _judge(suites, tables, profiles, parameters) -> DataFrame:
    wanted = set().union(*(suite.mentioned() for suite in suites.values()))
    frames = []
    for table in sorted({table for table, _ in wanted}):
        facts = {fact for owner, fact in wanted if owner == table}
        frames += profile(table, tables[table], profiles[table], facts)
    row = _side_by_side(frames, sorted(f"{table}.{fact}" for table, fact in wanted))

    verdicts, warn = {}, []
    for name, suite in suites.items():
        for check, sql in {"required_columns": "0", **suite.checks}.items():
            filled = _FACT.sub(r"`\1.\2`", sql.format(**parameters))
            verdicts[f"{name}|{check}"] = F.expr(filled).cast("bigint")
        warn += [f"{name}|{check}" for check in suite.warn]
    one_row = row.select(*[expr.alias(name) for name, expr in verdicts.items()])
    found = one_row.unpivot([], list(verdicts), "verdict", "violations")
    parts = F.split("verdict", r"\|")
    bad = F.when(F.col("verdict").isin(warn), WARN).otherwise(FAIL)
    return found.select(
        parts[0].alias("suite"),
        parts[1].alias("check"),
        "violations",
        F.when(F.col("violations") == 0, PASS).otherwise(bad).alias("status"),
    )
