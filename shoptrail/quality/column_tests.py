"""Generic column tests: not_null, unique, accepted_values, declared per relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shoptrail.quality.checks import FAIL, PASS, Profile, profile, rows_where, union_all

# Relation -> column -> tests.
NOT_NULL, UNIQUE = "not_null", "unique"
KEY = (NOT_NULL, UNIQUE)
SOURCE_TESTS = {
    "fct_sessions": {
        "session_id": KEY,
        "user_id": (NOT_NULL,),
        "session_date": (NOT_NULL,),
        "session_revenue": (NOT_NULL,),
        "converted": (NOT_NULL,),
    },
    "fct_purchases": {
        "purchase_id": KEY,
        "purchase_date": (NOT_NULL,),
        "purchase_amount": (NOT_NULL,),
        "session_id": (NOT_NULL,),
    },
    "agg_product_performance": {"product_id": KEY, "total_revenue": (NOT_NULL,)},
    "agg_conversion_funnel": {"session_date": KEY, "total_sessions": (NOT_NULL,)},
    "fct_cart_abandonment": {
        "session_id": KEY,
        "session_date": (NOT_NULL,),
        "abandoned": (NOT_NULL, ("accepted_values", (True,))),
    },
}
STAGING_TESTS = {
    "stg_fct_sessions": {"session_id": KEY, "session_date": (NOT_NULL,)},
    "stg_fct_purchases": {"purchase_id": KEY, "purchase_amount": (NOT_NULL,)},
    "stg_agg_product_performance": {"product_id": KEY},
    "stg_agg_conversion_funnel": {"session_date": KEY},
    "stg_fct_cart_abandonment": {"session_id": KEY},
}
MART_TESTS = {
    "mart_sessions": {"session_id": KEY, "converted": (NOT_NULL,)},
    "mart_product_performance": {"product_id": KEY, "total_revenue": (NOT_NULL,)},
    "mart_conversion_funnel": {"session_date": KEY, "total_sessions": (NOT_NULL,)},
}
ALL_TESTS = {**SOURCE_TESTS, **STAGING_TESTS, **MART_TESTS}


def _literal(value) -> str:
    return str(value) if isinstance(value, (bool, int, float)) else "'" + value.replace("'", "\\'") + "'"


def _declared(columns: dict) -> tuple[Profile, dict[str, tuple[str, str]]]:
    """A relation's tests as a profile, and which (column, test) each fact answers."""
    facts, keys, answers = {}, [], {}
    for column, tests in columns.items():
        for test in tests:
            kind = test if isinstance(test, str) else test[0]
            if kind == UNIQUE:
                keys.append(column)
                fact = f"{column}_repeated"
            elif kind == NOT_NULL:
                fact = f"{column}_missing"
                facts[fact] = rows_where(f"{column} IS NULL")
            else:
                fact = f"{column}_unexpected"
                allowed = ", ".join(_literal(value) for value in test[1])
                facts[fact] = f"count(DISTINCT CASE WHEN {column} NOT IN ({allowed}) THEN {column} END)"
            answers[fact] = (column, kind)
    return Profile(facts, tuple(keys)), answers


def column_tests(relations: dict[str, DataFrame], tests: dict = ALL_TESTS) -> DataFrame:
    """(relation, column_name, test, failures, status) for every declared test.

    Failures are NULL rows, values occurring more than once, or distinct values not allowed.
    """
    frames, named = [], []
    for relation, columns in tests.items():
        about, answers = _declared(columns)
        frames += profile(relation, relations[relation], about, set(answers))
        named += [(f"{relation}.{fact}", relation, *answer) for fact, answer in answers.items()]
    measured = union_all(frames)
    # One row per declared test, sent along with the plan.
    declared = measured.sparkSession.createDataFrame(
        named, "fact string, relation string, column_name string, test string"
    )
    failures = F.col("value").cast("bigint")
    return measured.join(F.broadcast(declared), "fact").select(
        "relation",
        "column_name",
        "test",
        failures.alias("failures"),
        F.when(failures == 0, PASS).otherwise(FAIL).alias("status"),
    )
