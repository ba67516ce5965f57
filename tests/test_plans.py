"""What the physical plans must and must not contain."""

import pytest
from builders import silver_rows

from shoptrail import schemas as S
from shoptrail.operators import carts, funnel, products, purchases, refine, sessionize, sessions
from shoptrail.plans import testdata


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    """Empty layers on disk: plans depend on schemas, not on rows. Without size-based broadcasts,
    as for tables too big for them."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    root = str(tmp_path_factory.mktemp("plans"))

    def layer(name, schema):
        spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")
        return spark.read.schema(schema).parquet(f"{root}/{name}")

    yield {
        "bronze": layer("bronze", S.BRONZE),
        "silver": layer("silver", S.SILVER),
        "session_events": layer("session_events", S.SESSION_EVENTS),
        "fct_sessions": layer("fct_sessions", S.FCT_SESSIONS),
    }
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(plan: str) -> int:
    return plan.count("Exchange hashpartitioning")


def build(layers):
    events, silver = layers["session_events"], layers["silver"]
    return {
        "silver": refine.to_silver(layers["bronze"]),
        "session_events": sessionize.order_sessions(silver),
        "fct_sessions": sessions.session_facts(silver),
        "fct_purchases": purchases.purchase_facts(events),
        "products": products.product_performance(events),
        "flags": funnel.session_flags(events),
        "funnel": funnel.conversion_funnel(funnel.session_flags(events)),
        "cart_details": carts.cart_details(events),
        "abandonment": carts.cart_abandonment(layers["fct_sessions"], carts.cart_details(events)),
    }


def test_nothing_multiplies_rows_or_leaves_the_jvm(layers):
    for name, df in build(layers).items():
        plan = plan_of(df)
        for bad in ("Expand", "CartesianProduct", "NestedLoop", "Python", "SinglePartition"):
            assert bad not in plan, (name, bad)


@pytest.mark.parametrize(
    "name, count",
    [
        ("silver", 1), ("session_events", 1), ("fct_sessions", 2), ("fct_purchases", 0), ("flags", 1),
        ("funnel", 2), ("cart_details", 2),
    ],
)
def test_shuffles(layers, name, count):
    assert shuffles(plan_of(build(layers)[name])) == count


def test_dedupe_limits_before_it_shuffles(layers):
    plan = plan_of(build(layers)["silver"])
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_one_sort_serves_all_session_windows(layers):
    plan = plan_of(build(layers)["session_events"])
    assert plan.count("Sort [") == 1


def test_aggregates_combine_before_they_shuffle(layers):
    for name in ("fct_sessions", "flags", "funnel", "cart_details"):
        plan = plan_of(build(layers)[name])
        assert plan.count("partial_") and "SortAggregate" not in plan, name


def test_filters_and_columns_reach_the_scan(layers):
    plans = {name: plan_of(df) for name, df in build(layers).items()}
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,purchase)]" in plans["fct_purchases"]
    assert "EqualTo(event_type,cart)" in plans["cart_details"]
    assert "brand" not in plans["fct_sessions"] and "kafka_topic" not in plans["silver"]
    assert "GreaterThan(cart_count,0)" in plans["abandonment"]


def test_text_stays_out_of_the_user_shuffle(layers):
    plan = plan_of(build(layers)["products"])
    by_user = [line for line in plan.splitlines() if "partial_count_if" in line or "keys=[_product" in line]
    assert by_user and not any("brand" in line and "user_id" in line for line in by_user)


def test_join_of_products_adds_no_shuffle_of_its_own(layers):
    # (product, user) and product for the measures; combination and product for the attributes
    assert shuffles(plan_of(build(layers)["products"])) == 4


def test_skew_settings_are_on(spark):
    silver_rows(spark, [{}])
    for key in ("adaptive.enabled", "adaptive.skewJoin.enabled", "ansi.enabled"):
        assert spark.conf.get(f"spark.sql.{key}") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


@pytest.mark.parametrize("mapped", [testdata.topic_records, testdata.sample_rows])
def test_rows_of_one_row_group_are_dealt_before_they_are_encoded(spark, mapped):
    plan = plan_of(mapped(spark.createDataFrame([], testdata.EVENTS).coalesce(1)))
    # A plan is printed from its result down: the shuffle lies below the copies and the encoding.
    assert shuffles(plan) == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning(event_id")


def test_streamed_rows_are_parsed_by_many_tasks(spark, tmp_path):
    spark.range(1_000).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.5D AS value", "'{}' AS props"
    ).coalesce(1).write.parquet(f"{tmp_path}/rows")
    (file,) = tmp_path.glob("rows/part-*.parquet")
    (tmp_path / "sf").mkdir()
    file.rename(tmp_path / "sf/events.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = []
    try:
        records = testdata.topic_records(testdata.stream_events(spark, f"{tmp_path}/sf"))
        query = records.writeStream.foreachBatch(lambda batch, _: parts.append(batch.rdd.getNumPartitions()))
        query.option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts == [4]
