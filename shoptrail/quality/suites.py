"""Profiles of all tables and the quality suites over them.

A check on rows reports how many break the rule; a comparison of row counts reports the difference;
a comparison of money reports 1 when it is off by more than a cent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoptrail import schemas as S
from shoptrail.quality.checks import Profile, Suite, blank, evaluate, rows_where

_TYPES = ", ".join(f"'{kind}'" for kind in S.EVENT_TYPES)
_UNKNOWN_TYPE = f"event_type IS NULL OR event_type NOT IN ({_TYPES})"
_STRICT_TIME = S.EVENT_TIME_STRICT.replace("\\", "\\\\")
_BARE_TIME = f"replace(event_time, '{S.EVENT_TIME_SUFFIX}', '')"
# Single-digit months, days and times are readable in a sample file, though not in bronze.
_LENIENT_FORMAT = "yyyy-M-d H:m:s"
_OFF_BY_A_CENT = f"> {S.MONEY_TOLERANCE}D"
# The audit columns of bronze come from the topic, so files without them are still bronze.
_BRONZE_REQUIRED = tuple(S.PAYLOAD.names) + ("event_date",)
_RATES = [name for name in S.AGG_CONVERSION_FUNNEL.names if name.endswith("_rate")]
_BY_TYPE = " + ".join(f"coalesce({kind}_count, 0)" for kind in S.EVENT_TYPES)


def _facts(rules: dict[str, str], **aggregates: str) -> dict[str, str]:
    counted = {name: rows_where(condition) for name, condition in rules.items()}
    return {"n_rows": "count(*)", **counted, **aggregates}


def _total(column: str) -> str:
    """Exact sum of money: of doubles, it would depend on the order of rows."""
    return f"coalesce(sum(try_cast({column} AS decimal(28, 4))), 0)"


PROFILES = {
    "sample": Profile(
        _facts(
            {
                "invalid_event_type": _UNKNOWN_TYPE,
                "unparseable_event_time": f"try_to_timestamp({_BARE_TIME}, '{_LENIENT_FORMAT}') IS NULL",
                "negative_price": "try_cast(price AS double) < 0",
            }
        ),
        keys=("event_id",),
        required=tuple(S.PAYLOAD.names),
    ),
    "bronze": Profile(
        _facts(
            {
                "blank_event_id": blank("event_id"),
                "invalid_event_type": _UNKNOWN_TYPE,
                "unparseable_event_time": (
                    f"event_time IS NULL OR NOT event_time RLIKE '{_STRICT_TIME}' "
                    f"OR try_to_timestamp({_BARE_TIME}, '{S.EVENT_TIME_FORMAT}') IS NULL"
                ),
                "null_event_date": "event_date IS NULL",
                "empty_rows": " AND ".join(f"{name} IS NULL" for name in _BRONZE_REQUIRED),
            }
        ),
        required=_BRONZE_REQUIRED,
    ),
    "quarantine": Profile(_facts({})),
    "silver": Profile(
        _facts(
            {
                "blank_event_id": blank("event_id"),
                "invalid_event_type": _UNKNOWN_TYPE,
                "null_event_ts": "event_ts IS NULL",
                "null_event_date": "event_date IS NULL",
                "null_product_id": "product_id IS NULL",
                "null_user_id": "user_id IS NULL",
                "blank_user_session": blank("user_session"),
                "negative_price": "price < 0",
                "nan_price": "isnan(price)",
            }
        ),
        keys=("event_id",),
        required=tuple(S.SILVER.names),
    ),
    "session_events": Profile(
        _facts(
            {
                "blank_event_id": blank("event_id"),
                "blank_session_id": blank("session_id"),
                "invalid_sequence": "event_seq_in_session IS NULL OR event_seq_in_session < 1",
                "negative_seconds": "seconds_from_session_start < 0",
                "null_session_start": "session_start_ts IS NULL",
                "purchases": "event_type = 'purchase'",
            },
            revenue=_total("CASE WHEN event_type = 'purchase' THEN price END"),
        ),
        keys=("session_id", "product_id"),
        required=tuple(S.SESSION_EVENTS.names),
    ),
    "fct_sessions": Profile(
        _facts(
            {
                "blank_session_id": blank("session_id"),
                "event_count_below_one": "event_count IS NULL OR event_count < 1",
                "negative_duration": "session_duration_seconds < 0",
                "negative_revenue": "session_revenue < 0",
                "type_counts_mismatch": f"coalesce(event_count, 0) <> {_BY_TYPE}",
                "converted_mismatch": (
                    "coalesce(converted, false) <> (coalesce(purchase_count, 0) > 0)"
                ),
                "abandoned": "coalesce(cart_count, 0) > 0 AND NOT coalesce(converted, false)",
            },
            revenue=_total("session_revenue"),
        ),
        keys=("session_id",),
        required=tuple(S.FCT_SESSIONS.names),
    ),
    "fct_purchases": Profile(
        _facts(
            {
                "blank_purchase_id": blank("purchase_id"),
                "blank_session_id": blank("session_id"),
                "null_product_id": "product_id IS NULL",
                "null_purchase_ts": "purchase_ts IS NULL",
                "negative_amount": "purchase_amount < 0",
            },
            revenue=_total("purchase_amount"),
        ),
        keys=("purchase_id",),
        required=tuple(S.FCT_PURCHASES.names),
    ),
    "agg_product_performance": Profile(
        _facts(
            {
                "null_product_id": "product_id IS NULL",
                "negative_revenue": "total_revenue < 0",
                "negative_view_count": "view_count < 0",
                "rate_out_of_range": (
                    "view_to_purchase_rate NOT BETWEEN 0 AND 1 "
                    "OR cart_to_purchase_rate NOT BETWEEN 0 AND 1"
                ),
                "revenue_without_purchases": (
                    "coalesce(purchase_count, 0) = 0 AND coalesce(total_revenue, 0D) <> 0D"
                ),
            },
            revenue=_total("total_revenue"),
        ),
        keys=("product_id",),
        required=tuple(S.AGG_PRODUCT_PERFORMANCE.names),
    ),
    "agg_conversion_funnel": Profile(
        _facts(
            {
                "rate_out_of_range": " OR ".join(f"{rate} NOT BETWEEN 0 AND 1" for rate in _RATES),
                "steps_above_total": (
                    "greatest(sessions_with_view, sessions_with_cart, 0) > coalesce(total_sessions, 0)"
                ),
                "abandoned_above_carts": (
                    "coalesce(abandoned_cart_sessions, 0) > coalesce(sessions_with_cart, 0)"
                ),
            },
            sessions="coalesce(sum(total_sessions), 0)",
        ),
        required=tuple(S.AGG_CONVERSION_FUNNEL.names),
    ),
    "fct_cart_abandonment": Profile(
        _facts(
            {
                "blank_session_id": blank("session_id"),
                "not_abandoned": "NOT coalesce(abandoned, false)",
                "cart_count_below_one": "cart_count IS NULL OR cart_count < 1",
                "null_first_cart_ts": "first_cart_ts IS NULL",
            }
        ),
        keys=("session_id",),
        required=tuple(S.FCT_CART_ABANDONMENT.names),
    ),
}


def _own(table: str, *names: str) -> dict[str, str]:
    """Facts of a table that are checks as they stand."""
    return {name: f"{table}.{name}" for name in names}


def _differ(left: str, right: str) -> str:
    return f"abs({left} - {right})"


def _exceed(left: str, right: str) -> str:
    return f"greatest({left} - {right}, 0)"


def _money_differs(left: str, right: str) -> str:
    return f"int(abs({left} - {right}) {_OFF_BY_A_CENT})"


BRONZE = Suite(
    "bronze",
    {
        "min_rows": "greatest({min_bronze_rows} - bronze.n_rows, 0)",
        **_own(
            "bronze", "blank_event_id", "invalid_event_type", "unparseable_event_time",
            "null_event_date", "empty_rows",
        ),
    },
)
_SILVER_CHECKS = {
    "min_rows": "greatest({min_silver_rows} - silver.n_rows, 0)",
    **_own(
        "silver", "blank_event_id", "invalid_event_type", "null_event_ts", "null_event_date",
        "null_product_id", "null_user_id", "blank_user_session", "negative_price", "nan_price",
    ),
    "duplicate_event_id": "silver.event_id_repeats",
}
SILVER_ALONE = Suite("silver", _SILVER_CHECKS, warn=("nan_price",))
SILVER = Suite(
    "silver",
    {**_SILVER_CHECKS, "rows_within_bronze": _exceed("silver.n_rows", "bronze.n_rows")},
    warn=("nan_price",),
)
SESSION_EVENTS = Suite(
    "session_events",
    {
        **_own(
            "session_events", "blank_event_id", "blank_session_id", "invalid_sequence",
            "negative_seconds", "null_session_start",
        ),
        "rows_match_silver": _differ("session_events.n_rows", "silver.n_rows"),
    },
)
FCT_SESSIONS = Suite(
    "fct_sessions",
    {
        "min_rows": "greatest({min_sessions} - fct_sessions.n_rows, 0)",
        **_own(
            "fct_sessions", "blank_session_id", "event_count_below_one", "negative_duration",
            "negative_revenue", "type_counts_mismatch", "converted_mismatch",
        ),
        "duplicate_session_id": "fct_sessions.session_id_repeats",
        "rows_match_sessions": _differ("fct_sessions.n_rows", "session_events.session_id_filled"),
    },
)
FCT_PURCHASES = Suite(
    "fct_purchases",
    {
        "min_rows": "greatest({min_purchases} - fct_purchases.n_rows, 0)",
        **_own(
            "fct_purchases", "blank_purchase_id", "blank_session_id", "null_product_id",
            "null_purchase_ts", "negative_amount",
        ),
        "duplicate_purchase_id": "fct_purchases.purchase_id_repeats",
        "rows_match_purchase_events": _differ("fct_purchases.n_rows", "session_events.purchases"),
    },
)
AGG_PRODUCT_PERFORMANCE = Suite(
    "agg_product_performance",
    {
        **_own(
            "agg_product_performance", "null_product_id", "negative_revenue",
            "negative_view_count", "rate_out_of_range", "revenue_without_purchases",
        ),
        "duplicate_product_id": "agg_product_performance.product_id_repeats",
        "rows_match_products": _differ(
            "agg_product_performance.n_rows", "session_events.product_id_values"
        ),
        "revenue_matches_events": _money_differs(
            "agg_product_performance.revenue", "session_events.revenue"
        ),
    },
)
AGG_CONVERSION_FUNNEL = Suite(
    "agg_conversion_funnel",
    {
        "rate_out_of_range": "agg_conversion_funnel.rate_out_of_range",
        "inconsistent_counts": (
            "agg_conversion_funnel.steps_above_total + agg_conversion_funnel.abandoned_above_carts"
        ),
        "sessions_match": _differ("agg_conversion_funnel.sessions", "fct_sessions.n_rows"),
    },
)
FCT_CART_ABANDONMENT = Suite(
    "fct_cart_abandonment",
    {
        "min_rows": "greatest({min_abandonments} - fct_cart_abandonment.n_rows, 0)",
        **_own(
            "fct_cart_abandonment", "blank_session_id", "not_abandoned", "cart_count_below_one",
            "null_first_cart_ts",
        ),
        "duplicate_session_id": "fct_cart_abandonment.session_id_repeats",
        "rows_match_sessions": _differ("fct_cart_abandonment.n_rows", "fct_sessions.abandoned"),
    },
)
_CROSS_CHECKS = {
    "session_events_match_silver": _differ("session_events.n_rows", "silver.n_rows"),
    "sessions_match_session_ids": _differ("fct_sessions.n_rows", "session_events.session_id_values"),
    "purchases_match_purchase_events": _differ("fct_purchases.n_rows", "session_events.purchases"),
    "session_revenue_matches_purchases": _money_differs(
        "fct_sessions.revenue", "fct_purchases.revenue"
    ),
    "purchase_revenue_matches_products": _money_differs(
        "fct_purchases.revenue", "agg_product_performance.revenue"
    ),
    "funnel_matches_sessions": _differ("agg_conversion_funnel.sessions", "fct_sessions.n_rows"),
}
CROSS_LAYER_WITHOUT_BRONZE = Suite("fct_sessions", _CROSS_CHECKS)
CROSS_LAYER = Suite(
    "fct_sessions",
    {"silver_within_bronze": _exceed("silver.n_rows", "bronze.n_rows"), **_CROSS_CHECKS},
)
SAMPLE = Suite(
    "sample",
    {
        "expected_rows": "abs(sample.n_rows - {expected_rows})",
        "duplicate_event_id": "sample.event_id_repeats",
        **_own("sample", "invalid_event_type", "unparseable_event_time", "negative_price"),
    },
)

MINIMUMS = {
    "min_bronze_rows": 1,
    "min_silver_rows": 1,
    "min_sessions": 1,
    "min_purchases": 1,
    "min_abandonments": 0,
}


def check(name: str, suite: Suite, tables: dict[str, DataFrame], **minimums: int) -> DataFrame:
    """Run one suite; ``tables`` may hold more than it needs."""
    return evaluate({name: suite}, tables, PROFILES, **{**MINIMUMS, **minimums})


def sample_file(rows: DataFrame, expected_rows: int) -> DataFrame:
    """Check an all-text sample, in which NULL stands for an empty field."""
    if "event_id" in rows.columns:
        # Empty ids repeat each other like any other value.
        rows = rows.fillna("", ["event_id"])
    return evaluate({"sample": SAMPLE}, {"sample": rows}, PROFILES, expected_rows=expected_rows)
