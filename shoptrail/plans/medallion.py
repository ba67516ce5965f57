"""The jobs a user runs: ingest, silver, gold, validate, serve, or all of it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shoptrail import schemas as S
from shoptrail.operators import carts, funnel, models, products, purchases, refine, sessionize, sessions
from shoptrail.plans import incremental
from shoptrail.plans.key_days import KeyDays
from shoptrail.plans.product_state import ProductState
from shoptrail.quality import gate, suites
from shoptrail.quality.checks import union_all
from shoptrail.quality.column_tests import column_tests
from shoptrail.session import sized_shuffles
from shoptrail.sources import load, publish
from shoptrail.sources.batches import BatchLog, read_sink
from shoptrail.sources.layers import (
    Counted,
    RunMetrics,
    drop_path,
    file_names,
    path_exists,
    read_dataset,
    read_layer,
    require_rows,
    write_layer,
)
from shoptrail.sources.sketches import KeySketch, frequent_keys
from shoptrail.streaming.ingest import BronzeSink, drain


@dataclass(frozen=True)
class Lake:
    """Where the layers live, on a file system all executors reach."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/events"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/bronze/quarantine"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/bronze/checkpoints/topic_to_bronze"

    @property
    def touched(self) -> str:
        """Days that were ingested and are not in silver and gold yet."""
        return f"{self.root}/bronze/touched"

    @property
    def id_days(self) -> str:
        """Index of the days on which an event id occurs in bronze."""
        return f"{self.root}/index/id_days"

    @property
    def session_days(self) -> str:
        """Index of the days on which a session occurs in silver and session events."""
        return f"{self.root}/index/session_days"

    @property
    def product_state(self) -> str:
        return f"{self.root}/state/product_performance"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/events"

    @property
    def session_events(self) -> str:
        return f"{self.root}/silver/session_events"

    @property
    def gold(self) -> str:
        return f"{self.root}/{S.CURATED_PREFIX}"

    @property
    def summary(self) -> str:
        return f"{self.gold}/dq_pipeline_summary.json"

    def gold_table(self, name: str) -> str:
        return f"{self.gold}/{name}"


def read_bronze(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_sink(spark, lake.bronze, S.BRONZE)


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_sink(spark, lake.quarantine, S.QUARANTINE)


def compact(spark: SparkSession, lake: Lake) -> dict[str, dict[str, int]]:
    """Fold the folders of all committed batches into one per sink, bronze by date and type."""
    with sized_shuffles(read_bronze(spark, lake)):
        return {
            "bronze": BatchLog(spark, lake.bronze).compact(S.BRONZE, ("event_date", "event_type")),
            "quarantine": BatchLog(spark, lake.quarantine).compact(S.QUARANTINE, ()),
        }


def _as_written(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A layer with the columns its files really have, so that checks can tell when some are
    missing. A job that had no rows to write leaves a folder without data files."""
    try:
        return read_dataset(spark, path)
    except FileNotFoundError:
        return read_layer(spark, path, schema)


def read_tables(spark: SparkSession, lake: Lake, gold_only: bool = False) -> dict[str, DataFrame]:
    """All layers by name, for checks. Gold is still compared against silver and session events."""
    places = {
        "silver": (lake.silver, S.SILVER),
        "session_events": (lake.session_events, S.SESSION_EVENTS),
        **{name: (lake.gold_table(name), schema) for name, (schema, _) in S.GOLD.items()},
    }
    found = {name: _as_written(spark, *place) for name, place in places.items()}
    if not gold_only:
        folders = BatchLog(spark, lake.bronze).folders()
        if folders:
            paths = [f"{lake.bronze}/{folder}" for folder in folders]
            found["bronze"] = spark.read.option("basePath", lake.bronze).parquet(*paths)
        else:
            found["bronze"] = _as_written(spark, lake.bronze, S.BRONZE)
    return found


def ingest(records: DataFrame, lake: Lake, **options) -> dict[str, int]:
    """Take what is new in the topic; or (``reset``) start over, beside earlier output or instead
    of it (``clear_outputs``)."""
    if options.get("clear_outputs"):
        KeyDays(lake.id_days).forget(records.sparkSession)
    sink = BronzeSink(lake.bronze, lake.quarantine, touched_path=lake.touched)
    return drain(records, sink, lake.checkpoint, **options)


def _counted_write(
    name: str, rows_read: int, built: DataFrame, path: str, partition: str | None, mode: str
) -> RunMetrics:
    """Write a table and count its rows on the way.

    The source is not counted the same way: filters and date ranges do not pass through a counter.
    ``append`` keeps partitions that the new rows do not touch and replaces the others, so building
    twice duplicates nothing; a table without partitions is replaced.
    """
    written = Counted(f"{name}_written")
    keep = mode == "append" and partition is not None
    write_layer(written.watch(built), path, partition, only_touched_partitions=keep)
    return RunMetrics(rows_read, written.rows)


def build_silver(
    spark: SparkSession, lake: Lake, mode: str = "overwrite", at: Column | None = None
) -> RunMetrics:
    bronze = read_bronze(spark, lake)
    rows = require_rows(bronze, "bronze")
    KeyDays(lake.session_days).forget(spark)
    seen = KeySketch("silver_sessions", "user_session")
    with sized_shuffles(bronze):
        metrics = _counted_write("silver", rows, seen.watch(refine.to_silver(bronze, at)), lake.silver, "event_date", mode)
    seen.keep(lake.silver, replace=mode != "append")
    return metrics


def _write_gold(name: str, rows_read: int, built: DataFrame, lake: Lake, mode: str) -> RunMetrics:
    partition = S.GOLD[name][1]
    return _counted_write(name, rows_read, built, lake.gold_table(name), partition, mode)


def build_sessions(
    spark: SparkSession, lake: Lake, mode: str = "overwrite", at: Column | None = None
) -> dict[str, RunMetrics]:
    silver = read_layer(spark, lake.silver, S.SILVER)
    rows = require_rows(silver, "silver")
    KeyDays(lake.session_days).forget(spark)
    with sized_shuffles(silver):
        ordered = sessionize.order_sessions(silver, at, frequent_keys(spark, lake.silver, silver, "user_session"))
        return {
            "session_events": _counted_write("session_events", rows, ordered, lake.session_events, "event_date", mode),
            "fct_sessions": _write_gold("fct_sessions", rows, sessions.session_facts(silver, at), lake, mode),
        }


def build_product_marts(
    spark: SparkSession, lake: Lake, mode: str = "overwrite", at: Column | None = None
) -> dict[str, RunMetrics]:
    events = read_layer(spark, lake.session_events, S.SESSION_EVENTS)
    rows = require_rows(events, "session events")
    ProductState(lake.product_state).forget(spark)  # the next update builds it from these events
    built = {
        "fct_purchases": purchases.purchase_facts(events, at),
        "agg_product_performance": products.product_performance(events, at),
    }
    with sized_shuffles(events):
        return {name: _write_gold(name, rows, df, lake, mode) for name, df in built.items()}


def build_funnel_marts(
    spark: SparkSession, lake: Lake, mode: str = "overwrite", at: Column | None = None
) -> dict[str, RunMetrics]:
    events = read_layer(spark, lake.session_events, S.SESSION_EVENTS)
    facts = read_layer(spark, lake.gold_table("fct_sessions"), S.FCT_SESSIONS)
    rows = require_rows(events, "session events")
    built = {
        "agg_conversion_funnel": funnel.conversion_funnel(funnel.session_flags(events), at),
        "fct_cart_abandonment": carts.cart_abandonment(facts, carts.cart_details(events), at),
    }
    with sized_shuffles(events):
        return {name: _write_gold(name, rows, df, lake, mode) for name, df in built.items()}


def build_gold(spark: SparkSession, lake: Lake, mode: str = "overwrite") -> dict[str, RunMetrics]:
    return {
        **build_sessions(spark, lake, mode),
        **build_product_marts(spark, lake, mode),
        **build_funnel_marts(spark, lake, mode),
    }


def verify(spark: SparkSession, lake: Lake, gold_only: bool = False, **options) -> str:
    """Check finished layers, write the summary next to the curated tables, return its status."""
    tables = read_tables(spark, lake, gold_only)
    with sized_shuffles(*tables.values()):
        return gate.write_summary(gate.validate(tables, gold_only=gold_only, **options), lake.summary)


def _section(name: str, checks: DataFrame, check: str = "check") -> DataFrame:
    """Checks of one part of the gate: (section, check, violations, status)."""
    return checks.select(F.lit(name).alias("section"), F.col(check).alias("check"), F.col("violations").cast("bigint").alias("violations"), "status")


def quality_gate(
    spark: SparkSession, lake: Lake, sample: DataFrame | None = None, sample_rows: int = 1_000_000, min_rows: int = 1_000_000,
    expected: dict[str, tuple[float, float]] = S.MILESTONES, reuse_summary: bool = False,
) -> DataFrame:
    """The release gate in one report: (section, check, violations, status).

    Sections: the sampled file (if given), structure of bronze and of silver, presence of the curated tables, drift against
    known-good numbers, and all suites. A layer that is not there fails its section. With ``reuse_summary`` the suites are not
    run again: the status that the last ``verify`` wrote counts, and none counts as failed.
    """
    def missing(section: str, what: str) -> DataFrame:
        return spark.createDataFrame([(section, what, 1, gate.FAIL)], "section string, check string, violations bigint, status string")

    have = {name: path_exists(spark, path) for name, path in (("bronze", lake.bronze), ("silver", lake.silver), ("gold", lake.gold))}
    parts = []
    if sample is not None:
        parts.append(_section("sample", suites.sample_file(sample, sample_rows)))
    bronze = read_bronze(spark, lake) if have["bronze"] else None
    if bronze is None:
        parts.append(missing("bronze_structure", "present"))
    else:
        rejected = read_quarantine(spark, lake) if path_exists(spark, lake.quarantine) else None
        parts.append(_section("bronze_structure", gate.bronze_structure(bronze, min_rows, rejected)))
    if bronze is None or not have["silver"]:
        parts.append(missing("silver_structure", "present"))
    else:
        parts.append(_section("silver_structure", gate.silver_structure(read_layer(spark, lake.silver, S.SILVER), bronze, min_rows)))
    presence = gate.gold_presence(spark, lake.gold).withColumn("violations", (F.col("status") == gate.FAIL).cast("bigint"))
    parts.append(_section("gold_presence", presence, "table_name"))
    whole = all(have.values()) and all(path_exists(spark, lake.gold_table(name)) for name in S.GOLD)
    if whole:
        tables = read_tables(spark, lake)
        drift = gate.milestones(tables, expected).withColumn("violations", (F.col("status") != "ok").cast("bigint"))
        parts.append(_section("milestones", drift.withColumn("status", F.when(F.col("violations") > 0, gate.FAIL).otherwise(gate.PASS)), "metric"))
    if reuse_summary:
        status = spark.read.schema("overall_status string").json(lake.summary).first() if path_exists(spark, lake.summary) else None
        sound = status is not None and status["overall_status"] == gate.PASS
        parts.append(missing("suites", "summary").select("section", "check", F.lit(int(not sound)).cast("bigint").alias("violations"), F.lit(gate.PASS if sound else gate.FAIL).alias("status")))
    elif whole:
        found = gate.validate(tables)
        parts.append(found.select(F.concat(F.lit("suite_"), "suite").alias("section"), "check", "violations", "status"))
    else:
        parts.append(missing("suites", "layers"))
    return union_all(parts)


@dataclass(frozen=True)
class Served:
    published: dict[str, int]
    tables: list[str]
    tests: DataFrame


def serve(
    spark: SparkSession, lake: Lake, target: str, staging_schema: str = "staging",
    marts_schema: str = "marts",
) -> Served:
    """Publish the curated layer, load it typed, build staging views and marts, and test them."""
    published = publish.publish(spark, lake.gold, target)
    loaded = load.load(spark, f"{target.rstrip('/')}/{S.CURATED_PREFIX}", staging_schema)
    staged = models.staging(loaded)
    models.materialise(staged, "view")
    tables = models.materialise(models.marts(staged), "table", marts_schema)
    built = {name: spark.table(f"{marts_schema}.{name}") for name in S.MARTS}
    return Served(published, tables, column_tests({**loaded, **staged, **built}))


def run(
    spark: SparkSession, lake: Lake, records: DataFrame, reset: bool = False,
    query_name: str = "topic_to_bronze", **minimums: int
) -> dict:
    """The whole chain from the topic to a validated gold layer.

    Takes what is new in the topic and brings the days up to date that it touches; a first run, or
    one with ``reset``, which empties bronze and reads the topic from its start, builds everything.
    """
    ingested = ingest(records, lake, reset=reset, clear_outputs=reset, query_name=query_name)
    noted = pending_batches(spark, lake)
    layers = [lake.silver, lake.session_events, *map(lake.gold_table, S.GOLD)]
    if reset or not all(path_exists(spark, path) for path in layers):
        KeyDays(lake.id_days).forget(spark)
        built = {"silver": build_silver(spark, lake), "gold": build_gold(spark, lake)}
    else:
        built = incremental.update(spark, lake, pending_days(spark, lake, noted))
    for folder in noted:  # what another ingest has noted meanwhile stays
        drop_path(spark, folder)
    return {"ingested": ingested, **built, "status": verify(spark, lake, **minimums)}


def pending_batches(spark: SparkSession, lake: Lake) -> list[str]:
    """Folders that note the days of batches ingested since silver and gold were last brought up to date."""
    found = []
    for run_folder in sorted(file_names(spark, lake.touched)):
        if run_folder.startswith("ingest_run="):
            found += [f"{lake.touched}/{run_folder}/{name}" for name in sorted(file_names(spark, f"{lake.touched}/{run_folder}"))]
    return found


def pending_days(spark: SparkSession, lake: Lake, batches: list[str] | None = None) -> incremental.Days:
    """Days of the given batches, or of all that silver and gold do not have yet."""
    batches = pending_batches(spark, lake) if batches is None else batches
    if not batches:
        return []
    return incremental.days_between(spark.read.schema("event_date date").parquet(*batches), None, None)


def update(spark: SparkSession, lake: Lake, since: str | None = None, until: str | None = None) -> dict:
    """Bring silver and gold up to date for a range of days."""
    days = incremental.days_between(read_bronze(spark, lake), since, until)
    return incremental.update(spark, lake, days, pending=pending_days(spark, lake))
