"""Per-session funnel flags and the daily conversion funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shoptrail import schemas as S
from shoptrail.functions.columns import capped_ratio, stamp

_STEPS = ("view", "cart", "purchase")
_PATHS = (("view", "cart"), ("cart", "purchase"), ("view", "purchase"))


def _comes_before(first: str, then: str) -> Column:
    """The first event of one step precedes that of the other; false when either is missing."""
    return F.coalesce(F.col(f"first_{first}_seq") < F.col(f"first_{then}_seq"), F.lit(False))


def session_flags(session_events: DataFrame) -> DataFrame:
    """One row per session: which steps occur, where each occurs first, and in what order.

    A step occurs exactly when it has a first position, so positions are all that is aggregated.
    """
    firsts = session_events.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("event_date").alias("session_date"),
        *[
            F.min(F.when(F.col("event_type") == step, F.col("event_seq_in_session"))).alias(
                f"first_{step}_seq"
            )
            for step in _STEPS
        ],
    )
    occurs = {step: F.col(f"first_{step}_seq").isNotNull() for step in _STEPS}
    return firsts.select(
        "session_id",
        "user_id",
        "session_date",
        *[occurs[step].cast("int").alias(f"has_{step}") for step in _STEPS],
        *[f"first_{step}_seq" for step in _STEPS],
        *[_comes_before(a, b).alias(f"has_strict_{a}_to_{b}") for a, b in _PATHS],
        (occurs["cart"] & ~occurs["purchase"]).alias("is_cart_abandoned"),
    )


def conversion_funnel(flags: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """One row per session date; every measure is a count over sessions."""
    daily = flags.groupBy("session_date").agg(
        F.count("*").alias("total_sessions"),
        *[F.count_if(F.col(f"has_{step}") == 1).alias(f"sessions_with_{step}") for step in _STEPS],
        *[F.count_if(f"has_strict_{a}_to_{b}").alias(f"{a}_to_{b}_sessions") for a, b in _PATHS],
        F.count_if("is_cart_abandoned").alias("abandoned_cart_sessions"),
    )
    rates = {
        f"{a}_to_{b}_rate": capped_ratio(F.col(f"{a}_to_{b}_sessions"), F.col(f"sessions_with_{a}"))
        for a, b in _PATHS
    }
    rates["cart_abandonment_rate"] = capped_ratio(
        F.col("abandoned_cart_sessions"), F.col("sessions_with_cart")
    )
    return daily.withColumns({**rates, "gold_processed_at": stamp(processed_at)}).select(
        *S.AGG_CONVERSION_FUNNEL.names
    )
