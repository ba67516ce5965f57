"""Structural checks and milestones of the release gate, the orchestrated suites and their summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoptrail import schemas as S
from shoptrail.functions.columns import stamp
from shoptrail.quality import suites
from shoptrail.quality.checks import (
    FAIL,
    PASS,
    Suite,
    evaluate,
    missing_columns,
    profile,
    union_all,
)
from shoptrail.sources.layers import read_dataset

_TOPIC_COLUMNS = ["kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "ingested_at"]


def bronze_structure(
    events: DataFrame, min_rows: int = 1_000_000, quarantine: DataFrame | None = None
) -> DataFrame:
    """Enough rows, topic columns, partition columns, and whether anything was quarantined."""
    tables = {"bronze": events}
    checks = {
        "min_rows": "greatest({min_rows} - bronze.n_rows, 0)",
        "topic_columns": str(len(missing_columns(events, _TOPIC_COLUMNS))),
        "partition_columns": str(len(missing_columns(events, ["event_date", "event_type"]))),
    }
    if quarantine is not None:
        tables["quarantine"] = quarantine
        checks["quarantined_rows"] = "quarantine.n_rows"
    suite = Suite("bronze", checks, warn=("quarantined_rows",))
    return evaluate({"bronze_structure": suite}, tables, suites.PROFILES, min_rows=min_rows)


def silver_structure(events: DataFrame, bronze_events: DataFrame, min_rows: int = 1_000_000) -> DataFrame:
    checks = {
        "min_rows": "greatest({min_rows} - silver.n_rows, 0)",
        "rows_within_bronze": "greatest(silver.n_rows - bronze.n_rows, 0)",
        "duplicate_event_id": "silver.event_id_repeats",
        "cleaned_columns": str(len(missing_columns(events, ["event_ts", "category_code", "brand"]))),
    }
    tables = {"silver": events, "bronze": bronze_events}
    return evaluate(
        {"silver_structure": Suite("silver", checks)}, tables, suites.PROFILES, min_rows=min_rows
    )


def gold_presence(spark: SparkSession, root: str) -> DataFrame:
    """(table_name, row_count, status) for every curated table; a missing table has no count. A
    table counts as present once it has files."""
    found = []
    for name in S.GOLD:
        try:
            counted = read_dataset(spark, f"{root}/{name}").agg(F.count("*").alias("row_count"))
        except FileNotFoundError:
            counted = spark.sql("SELECT CAST(NULL AS BIGINT) AS row_count")
        status = F.when(F.col("row_count").isNull(), FAIL).otherwise(PASS).alias("status")
        found.append(counted.select(F.lit(name).alias("table_name"), "row_count", status))
    return union_all(found)


_MILESTONE_FACTS = {
    "bronze_rows": ("bronze", "n_rows"),
    "silver_rows": ("silver", "n_rows"),
    "fct_sessions": ("fct_sessions", "n_rows"),
    "fct_purchases": ("fct_purchases", "n_rows"),
    "agg_product_performance": ("agg_product_performance", "n_rows"),
    "fct_cart_abandonment": ("fct_cart_abandonment", "n_rows"),
    "total_revenue": ("fct_purchases", "revenue"),
}


def milestones(
    tables: dict[str, DataFrame], expected: dict[str, tuple[float, float]] = S.MILESTONES
) -> DataFrame:
    """(metric, actual, expected, tolerance, delta, status): drift against known-good numbers."""
    frames = []
    for table in dict.fromkeys(table for table, _ in _MILESTONE_FACTS.values()):
        facts = {fact for owner, fact in _MILESTONE_FACTS.values() if owner == table}
        frames += profile(table, tables[table], suites.PROFILES[table], facts)
    actual = union_all(frames)
    # A handful of constants, sent along with the plan.
    targets = actual.sparkSession.createDataFrame(
        [
            (".".join(_MILESTONE_FACTS[metric]), metric, float(value), float(slack))
            for metric, (value, slack) in expected.items()
        ],
        "fact string, metric string, expected double, tolerance double",
    )
    delta = F.abs(F.col("value") - F.col("expected"))
    return actual.join(F.broadcast(targets), "fact").select(
        "metric",
        F.col("value").alias("actual"),
        "expected",
        "tolerance",
        delta.alias("delta"),
        F.when(delta <= F.col("tolerance"), "ok").otherwise("DRIFT").alias("status"),
    )


def validate(
    tables: dict[str, DataFrame], *, skip_bronze: bool = False, gold_only: bool = False, **minimums: int
) -> DataFrame:
    """All suites over a finished run, as one frame of checks.

    Facts several suites mention are computed once. Minimums: see ``suites.MINIMUMS``.
    """
    with_bronze = not (skip_bronze or gold_only)
    chosen = {}
    if with_bronze:
        chosen["bronze"] = suites.BRONZE
    if not gold_only:
        # Silver is held against bronze whether or not bronze itself is checked.
        chosen["silver"] = suites.SILVER if "bronze" in tables else suites.SILVER_ALONE
        chosen["session_events"] = suites.SESSION_EVENTS
        chosen["fct_sessions"] = suites.FCT_SESSIONS
    chosen |= {
        "fct_purchases": suites.FCT_PURCHASES,
        "agg_product_performance": suites.AGG_PRODUCT_PERFORMANCE,
        "agg_conversion_funnel": suites.AGG_CONVERSION_FUNNEL,
        "fct_cart_abandonment": suites.FCT_CART_ABANDONMENT,
        "cross_layer": suites.CROSS_LAYER if with_bronze else suites.CROSS_LAYER_WITHOUT_BRONZE,
    }
    return evaluate(chosen, tables, suites.PROFILES, **{**suites.MINIMUMS, **minimums})


def summarise(checks: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """One row: generated_at, overall_status, checks[name, status, details[]].

    There is one entry per suite, and its details name the checks it fails.
    """
    failing = F.when(
        F.col("status") == FAIL,
        F.concat(F.col("check"), F.lit(": "), F.col("violations").cast("string")),
    )
    per_suite = checks.groupBy("suite").agg(
        F.max(F.col("status") == FAIL).alias("failed"), F.sort_array(F.collect_list(failing)).alias("found")
    )
    status = F.when(F.col("failed"), FAIL).otherwise(PASS)
    details = F.when(F.col("failed"), F.col("found")).otherwise(F.array(F.lit("ok")))
    entry = F.struct(F.col("suite").alias("name"), status.alias("status"), details.alias("details"))
    return per_suite.agg(
        F.date_format(stamp(generated_at), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("generated_at"),
        F.when(F.max("failed"), FAIL).otherwise(PASS).alias("overall_status"),
        F.sort_array(F.collect_list(entry)).alias("checks"),
    )


def write_summary(checks: DataFrame, path: str, generated_at: Column | None = None) -> str:
    """Write the summary document and return the overall status."""
    document = summarise(checks, generated_at).coalesce(1)
    document.write.mode("overwrite").json(path)
    written = checks.sparkSession.read.schema("overall_status string").json(path)
    return written.first()["overall_status"]
