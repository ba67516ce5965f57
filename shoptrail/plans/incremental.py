"""Bring silver and gold up to date for some days, leaving all other days as they are.

A day's result depends on other days: an id may be delivered again later, a session may pass midnight.
So the days to write are those of all rows that share a key with a row of the given days, and the days
to read those of all rows that share a key with a row of the days to write. Both come from indexes of the days on
which a key occurs; of the layers only the days to read are opened. The result equals that of a build of everything.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from shoptrail import schemas as S
from shoptrail.functions.columns import is_filled
from shoptrail.operators import carts, funnel, purchases, refine, sessionize, sessions
from shoptrail.plans.key_days import KeyDays
from shoptrail.plans.product_state import ProductState
from shoptrail.session import sized_shuffles
from shoptrail.sources.batches import read_sink
from shoptrail.sources.layers import path_exists, read_layer, replace_days
from shoptrail.sources.sketches import KeySketch, frequent_keys

Days = list[dt.date]


def days_between(layer: DataFrame, since: str | None, until: str | None, day: str = "event_date") -> Days:
    """Days of a layer within a closed range; an end that is not given is open."""
    chosen = layer.select(day)
    if since is not None:
        chosen = chosen.where(F.col(day) >= F.lit(since).cast("date"))
    if until is not None:
        chosen = chosen.where(F.col(day) <= F.lit(until).cast("date"))
    return _days(chosen, day)


def _days(rows: DataFrame, day: str) -> Days:
    """One value per day of the layer reaches the driver."""
    return sorted(row[0] for row in rows.select(day).distinct().collect() if row[0] is not None)


def _on(day: str, days: Iterable[dt.date]) -> Column:
    return F.col(day).isin(list(days))


def linked_days(index: KeyDays, rows: DataFrame, days: Days) -> Days:
    """The given days, and those of all rows (key, day) whose key occurs on one of them."""
    return sorted({*days, *index.others(rows.where(_on("day", days)).select("key"), days)})


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A layer, or no rows where it has not been built yet."""
    return read_layer(spark, path, schema) if path_exists(spark, path) else spark.createDataFrame([], schema)


def _ids(bronze: DataFrame) -> DataFrame:
    return bronze.where(is_filled(F.col("event_id"))).select(F.col("event_id").alias("key"), F.col("event_date").alias("day"))


def _sessions(layer: DataFrame, session: str) -> DataFrame:
    return layer.select(F.col(session).alias("key"), F.col("event_date").alias("day"))


def update_silver(spark: SparkSession, lake, days: Days, at: Column | None = None, pending: Days = ()) -> Days:
    """Rebuild silver where the given days of bronze matter; returns the days written.

    ``pending`` are days that were ingested since the index of ids was brought up to date.
    """
    bronze, index = read_sink(spark, lake.bronze, S.BRONZE), KeyDays(lake.id_days)
    with sized_shuffles(bronze):
        if index.known(spark):
            index.note(_ids(bronze), sorted({*days, *pending}))
        else:
            index.build(_ids(bronze))
        written = linked_days(index, _ids(bronze), days)
        source = bronze.where(_on("event_date", linked_days(index, _ids(bronze), written)))
        seen = KeySketch("silver_update", "user_session")
        replace_days(seen.watch(refine.to_silver(source, at)), lake.silver, "event_date", written)
        seen.keep(lake.silver, replace=False)
    return written


def update_gold(spark: SparkSession, lake, days: Days, at: Column | None = None) -> Days:
    """Rebuild session events and curated tables where the given days of silver matter.

    Sessions of the stored session events count too: rows may have left silver. The index of sessions holds them until
    the new ones are written. Product performance is brought up to date from its state.
    """
    silver, index = read_layer(spark, lake.silver, S.SILVER), KeyDays(lake.session_days)
    old = _stored(spark, lake.session_events, S.SESSION_EVENTS)
    seen, before = _sessions(silver, "user_session"), _sessions(old, "session_id")
    with sized_shuffles(silver):
        if not index.known(spark):
            index.build(seen.unionByName(before))
        written = linked_days(index, seen.unionByName(before), days)
        # What is new in silver counts from here on, beside what the index still has of the rows that left.
        now = sorted({*written, *index.others(seen.where(_on("day", written)).select("key"), written)})
        part = silver.where(_on("event_date", now))
        heavy = frequent_keys(spark, lake.silver, part, "user_session")
        replace_days(sessionize.order_sessions(part, at, heavy), lake.session_events, "event_date", written)
        events = read_layer(spark, lake.session_events, S.SESSION_EVENTS)
        # Sessions that start on a day to write have all their events on the days to read.
        some = events.where(_on("event_date", now))
        replace_days(sessions.session_facts(part, at), lake.gold_table("fct_sessions"), "session_date", written)
        facts = read_layer(spark, lake.gold_table("fct_sessions"), S.FCT_SESSIONS).where(_on("session_date", written))
        built = {
            "fct_purchases": purchases.purchase_facts(some, at),
            "agg_conversion_funnel": funnel.conversion_funnel(funnel.session_flags(some), at),
            "fct_cart_abandonment": carts.cart_abandonment(facts, carts.cart_details(some), at),
        }
        for name, df in built.items():
            replace_days(df, lake.gold_table(name), S.GOLD[name][1], written)
        ProductState(lake.product_state).update(events, written, lake.gold_table("agg_product_performance"), at)
        index.note(seen, written)
    return written


def update(spark: SparkSession, lake, days: Days, at: Column | None = None, pending: Days = ()) -> dict[str, Days]:
    """Bring silver and gold up to date with what bronze has on the given days; returns the days written."""
    if not days:
        return {"silver": [], "gold": []}
    silver = update_silver(spark, lake, days, at, pending)
    return {"silver": silver, "gold": update_gold(spark, lake, silver, at)}
