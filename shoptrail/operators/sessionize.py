"""Order events inside the session key they arrive with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shoptrail import schemas as S
from shoptrail.functions.columns import seconds_between, stamp
from shoptrail.operators.skew import number_in_slices, split_by_keys


def _ordinary(silver: DataFrame) -> DataFrame:
    """All measures from one shuffle and one sort on the session key."""
    session = Window.partitionBy("user_session")
    timeline = session.orderBy(F.col("event_ts").asc_nulls_last(), F.col("event_id").asc_nulls_last())
    return silver.withColumns(
        {
            "event_seq_in_session": F.row_number().over(timeline).cast("bigint"),
            "session_start_ts": F.min("event_ts").over(session),
            "session_end_ts": F.max("event_ts").over(session),
        }
    )


def _oversized(silver: DataFrame) -> DataFrame:
    return number_in_slices(
        silver,
        "user_session",
        ["event_ts", "event_id"],
        "event_seq_in_session",
        {
            "session_start_ts": (F.col("event_ts"), "min"),
            "session_end_ts": (F.col("event_ts"), "max"),
        },
    )


def order_sessions(
    silver: DataFrame,
    sessionized_at: Column | None = None,
    heavy_sessions: Sequence[str] = (),
) -> DataFrame:
    """Silver rows with their place in the session, the session's bounds and seconds since its start.

    ``heavy_sessions``, those too big for one task, are numbered across many tasks; the others share a single window,
    which spills. The result is the same either way. A stored layer has them noted beside it
    (``sketches.frequent_keys``); of other rows ``skew.heavy_keys`` counts them.
    """
    if heavy_sessions:
        heavy, light = split_by_keys(silver, "user_session", list(heavy_sessions))
        ordered = _ordinary(light).unionByName(_oversized(heavy))
    else:
        ordered = _ordinary(silver)
    return (
        ordered.withColumnRenamed("user_session", "session_id")
        .withColumns(
            {
                "seconds_from_session_start": seconds_between(
                    F.col("session_start_ts"), F.col("event_ts")
                ),
                "sessionized_at": stamp(sessionized_at),
            }
        )
        .select(*S.SESSION_EVENTS.names)
    )
