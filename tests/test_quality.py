"""Every check passes on clean layers and fails, alone, on one planted fault."""

import json

import pytest
from builders import event, make, silver_rows, utc
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators import carts, funnel, models, products, purchases, sessionize, sessions
from shoptrail.quality import gate, suites
from shoptrail.quality.checks import union_all
from shoptrail.quality.column_tests import ALL_TESTS, column_tests

ROWS = [
    {"event_type": "view", "at": "2019-10-01T00:00:00"},
    {"event_type": "cart", "at": "2019-10-01T00:00:05"},
    {"event_type": "purchase", "at": "2019-10-01T00:00:09", "price": 5.0},
    {"event_type": "view", "user_session": "s2", "user_id": 8, "at": "2019-10-02T00:00:00"},
    {"event_type": "cart", "user_session": "s2", "user_id": 8, "product_id": 2, "at": "2019-10-02T00:00:01"},
]


@pytest.fixture(scope="module")
def clean(spark):
    silver = silver_rows(spark, ROWS)
    day = utc("2019-10-01T00:00:00")
    bronze = make(
        spark,
        S.BRONZE,
        [{**event(i), "event_date": day.date(), "ingested_at": day, "kafka_offset": i} for i in range(6)],
    )
    events = sessionize.order_sessions(silver)
    facts = sessions.session_facts(silver)
    built = {
        "bronze": bronze,
        "silver": silver,
        "session_events": events,
        "fct_sessions": facts,
        "fct_purchases": purchases.purchase_facts(events),
        "agg_product_performance": products.product_performance(events),
        "agg_conversion_funnel": funnel.conversion_funnel(funnel.session_flags(events)),
        "fct_cart_abandonment": carts.cart_abandonment(facts, carts.cart_details(events)),
    }
    return {name: df.cache() for name, df in built.items()}


def failing(checks):
    return {(r.suite, r.check) for r in checks.collect() if r.status == "FAIL"}


def test_clean_layers_pass(clean):
    checks = gate.validate(clean).collect()
    assert [r for r in checks if r.status != "PASS"] == []
    assert len({r.suite for r in checks}) == 9
    assert len(checks) == len({(r.suite, r.check) for r in checks}) == 75


def one_row(df, key, column, value):
    """Change a column of the row with the smallest key."""
    first = df.agg(F.min(key)).first()[0]
    kind = df.schema[column].dataType
    changed = F.when(F.col(key) == F.lit(first), F.expr(value).cast(kind)).otherwise(F.col(column))
    return df.withColumn(column, changed)


def extra(df, key, **changes):
    """Add a copy of the row with the smallest key, changed."""
    first = df.agg(F.min(key)).first()[0]
    more = df.where(F.col(key) == F.lit(first))
    for column, value in changes.items():
        more = more.withColumn(column, F.expr(value).cast(df.schema[column].dataType))
    return df.unionByName(more)


PLANTED = [
    ("bronze", "blank_event_id", "bronze", "event_id", ("event_id", "' \t'")),
    ("bronze", "invalid_event_type", "bronze", "event_id", ("event_type", "'error'")),
    ("bronze", "unparseable_event_time", "bronze", "event_id", ("event_time", "'2019-10-01 00:00:00'")),
    ("bronze", "unparseable_event_time", "bronze", "event_id", ("event_time", "'2019-02-29 00:00:00 UTC'")),
    ("bronze", "null_event_date", "bronze", "event_id", ("event_date", "NULL")),
    ("silver", "blank_event_id", "silver", "event_id", ("event_id", "''")),
    ("silver", "invalid_event_type", "silver", "event_id", ("event_type", "NULL")),
    ("silver", "null_event_ts", "silver", "event_id", ("event_ts", "NULL")),
    ("silver", "null_event_date", "silver", "event_id", ("event_date", "NULL")),
    ("silver", "null_product_id", "silver", "event_id", ("product_id", "NULL")),
    ("silver", "null_user_id", "silver", "event_id", ("user_id", "NULL")),
    ("silver", "blank_user_session", "silver", "event_id", ("user_session", "'\n'")),
    ("silver", "negative_price", "silver", "event_id", ("price", "-1")),
    ("silver", "duplicate_event_id", "silver", "event_id", ("event_id", "'e001'")),
    ("session_events", "blank_event_id", "session_events", "event_id", ("event_id", "NULL")),
    ("session_events", "invalid_sequence", "session_events", "event_id", ("event_seq_in_session", "0")),
    ("session_events", "negative_seconds", "session_events", "event_id", ("seconds_from_session_start", "-1")),
    ("session_events", "null_session_start", "session_events", "event_id", ("session_start_ts", "NULL")),
    ("fct_sessions", "blank_session_id", "fct_sessions", "session_id", ("session_id", "' '")),
    ("fct_sessions", "negative_duration", "fct_sessions", "session_id", ("session_duration_seconds", "-1")),
    ("fct_sessions", "type_counts_mismatch", "fct_sessions", "session_id", ("event_count", "99")),
    ("fct_sessions", "duplicate_session_id", "fct_sessions", "session_id", ("session_id", "'s2'")),
    ("fct_purchases", "blank_purchase_id", "fct_purchases", "purchase_id", ("purchase_id", "''")),
    ("fct_purchases", "blank_session_id", "fct_purchases", "purchase_id", ("session_id", "NULL")),
    ("fct_purchases", "null_product_id", "fct_purchases", "purchase_id", ("product_id", "NULL")),
    ("fct_purchases", "null_purchase_ts", "fct_purchases", "purchase_id", ("purchase_ts", "NULL")),
    ("agg_product_performance", "null_product_id", "agg_product_performance", "product_id", ("product_id", "NULL")),
    ("agg_product_performance", "negative_view_count", "agg_product_performance", "product_id", ("view_count", "-1")),
    ("agg_product_performance", "rate_out_of_range", "agg_product_performance", "product_id", ("view_to_purchase_rate", "1.5")),
    ("agg_product_performance", "rate_out_of_range", "agg_product_performance", "product_id", ("cart_to_purchase_rate", "-0.1")),
    ("agg_product_performance", "revenue_without_purchases", "agg_product_performance", "product_id", ("purchase_count", "0")),
    ("agg_product_performance", "duplicate_product_id", "agg_product_performance", "product_id", ("product_id", "2")),
    ("agg_conversion_funnel", "rate_out_of_range", "agg_conversion_funnel", "session_date", ("cart_abandonment_rate", "2")),
    ("agg_conversion_funnel", "inconsistent_counts", "agg_conversion_funnel", "session_date", ("sessions_with_view", "9")),
    ("agg_conversion_funnel", "inconsistent_counts", "agg_conversion_funnel", "session_date", ("abandoned_cart_sessions", "9")),
    ("fct_cart_abandonment", "blank_session_id", "fct_cart_abandonment", "session_id", ("session_id", "''")),
    ("fct_cart_abandonment", "not_abandoned", "fct_cart_abandonment", "session_id", ("abandoned", "false")),
    ("fct_cart_abandonment", "cart_count_below_one", "fct_cart_abandonment", "session_id", ("cart_count", "0")),
    ("fct_cart_abandonment", "null_first_cart_ts", "fct_cart_abandonment", "session_id", ("first_cart_ts", "NULL")),
]


@pytest.mark.parametrize("suite, check, table, key, change", PLANTED, ids=lambda v: str(v)[:40])
def test_planted_row_fails_alone(clean, suite, check, table, key, change):
    broken = {**clean, table: one_row(clean[table], key, *change)}
    assert failing(suites.check(suite, getattr(suites, suite.upper()), broken)) == {(suite, check)}


@pytest.mark.parametrize(
    "suite, table, key, changes, expected",
    [
        # A row too many, elsewhere or here; what the row breaks on its own is named as well.
        ("bronze", "bronze", "event_id", {c: "NULL" for c in S.PAYLOAD.names + ["event_date"]},
         {"empty_rows", "blank_event_id", "invalid_event_type", "unparseable_event_time", "null_event_date"}),
        ("session_events", "silver", "event_id", {}, {"rows_match_silver"}),
        ("session_events", "session_events", "event_id", {"session_id": "''"}, {"rows_match_silver", "blank_session_id"}),
        ("fct_sessions", "session_events", "event_id", {"session_id": "'s9'"}, {"rows_match_sessions"}),
        ("fct_purchases", "session_events", "event_id", {"event_type": "'purchase'"}, {"rows_match_purchase_events"}),
        ("agg_product_performance", "session_events", "event_id", {"product_id": "9"}, {"rows_match_products"}),
        ("agg_product_performance", "session_events", "event_id", {"event_type": "'purchase'"}, {"revenue_matches_events"}),
        ("agg_conversion_funnel", "fct_sessions", "session_id", {}, {"sessions_match"}),
        ("fct_cart_abandonment", "fct_sessions", "session_id", {"converted": "false"}, {"rows_match_sessions"}),
        ("fct_cart_abandonment", "fct_cart_abandonment", "session_id", {}, {"rows_match_sessions", "duplicate_session_id"}),
    ],
)
def test_planted_extra_row(clean, suite, table, key, changes, expected):
    broken = {**clean, table: extra(clean[table], key, **changes)}
    assert {c for _, c in failing(suites.check(suite, getattr(suites, suite.upper()), broken))} == expected


@pytest.mark.parametrize(
    "suite, changes, expected",
    [
        ("fct_sessions", [("event_count", "0")], {"event_count_below_one", "type_counts_mismatch"}),
        ("fct_sessions", [("converted", "false")], {"converted_mismatch"}),
        ("fct_sessions", [("session_revenue", "-1")], {"negative_revenue"}),
        ("fct_purchases", [("purchase_amount", "-1")], {"negative_amount"}),
        ("agg_product_performance", [("total_revenue", "-1")], {"negative_revenue", "revenue_matches_events"}),
        ("agg_product_performance", [("total_revenue", "5.005")], set()),
        ("agg_product_performance", [("total_revenue", "5.02")], {"revenue_matches_events"}),
    ],
)
def test_planted_values(clean, suite, changes, expected):
    frame = clean[suite]
    for change in changes:
        frame = one_row(frame, frame.columns[0], *change)
    found = failing(suites.check(suite, getattr(suites, suite.upper()), {**clean, suite: frame}))
    assert {c for _, c in found} == expected


def test_minimum_rows_and_silver_within_bronze(clean):
    assert failing(suites.check("bronze", suites.BRONZE, clean, min_bronze_rows=7)) == {("bronze", "min_rows")}
    small = {**clean, "bronze": clean["bronze"].limit(4)}
    assert failing(suites.check("silver", suites.SILVER, small)) == {("silver", "rows_within_bronze")}
    assert failing(suites.check("silver", suites.SILVER_ALONE, small, min_silver_rows=6)) == {("silver", "min_rows")}
    for suite, minimum in (("fct_sessions", "min_sessions"), ("fct_purchases", "min_purchases"), ("fct_cart_abandonment", "min_abandonments")):
        found = failing(suites.check(suite, getattr(suites, suite.upper()), clean, **{minimum: 100}))
        assert found == {(suite, "min_rows")}


def test_nan_price_warns_only(clean):
    broken = {**clean, "silver": one_row(clean["silver"], "event_id", "price", "double('NaN')")}
    got = {r.check: r.status for r in suites.check("silver", suites.SILVER, broken).collect()}
    assert got["nan_price"] == "WARN" and "FAIL" not in got.values()


CROSS = [
    ("silver_within_bronze", "bronze", lambda df: df.limit(1)),
    ("session_events_match_silver", "silver", lambda df: df.limit(4)),
    ("sessions_match_session_ids", "session_events", lambda df: df.withColumn("session_id", F.lit("s1"))),
    ("purchases_match_purchase_events", "session_events", lambda df: df.withColumn("event_type", F.lit("view"))),
    ("session_revenue_matches_purchases", "fct_sessions", lambda df: df.withColumn("session_revenue", F.lit(1.0))),
    ("purchase_revenue_matches_products", "agg_product_performance", lambda df: df.withColumn("total_revenue", F.lit(1.0))),
    ("funnel_matches_sessions", "agg_conversion_funnel", lambda df: df.withColumn("total_sessions", F.lit(9))),
]


@pytest.mark.parametrize("check, table, breaks", CROSS, ids=[c[0] for c in CROSS])
def test_cross_layer(clean, check, table, breaks):
    broken = {**clean, table: breaks(clean[table])}
    assert failing(suites.check("cross_layer", suites.CROSS_LAYER, broken)) == {("cross_layer", check)}


def test_missing_column_is_reported_and_nothing_else(clean):
    broken = {**clean, "silver": clean["silver"].drop("brand", "price")}
    got = [(r.check, r.violations, r.status) for r in suites.check("silver", suites.SILVER, broken).collect()]
    assert got == [("required_columns", 2, "FAIL")]
    bronze = {"bronze": clean["bronze"].drop("kafka_topic")}
    assert failing(suites.check("bronze", suites.BRONZE, bronze)) == set()


def test_scope_of_the_orchestrated_run(clean):
    def suites_of(**options):
        return {r.suite for r in gate.validate(clean, **options).select("suite").distinct().collect()}

    gold = {"fct_purchases", "agg_product_performance", "agg_conversion_funnel", "fct_cart_abandonment", "cross_layer"}
    assert suites_of(gold_only=True) == gold
    assert suites_of(skip_bronze=True) == gold | {"silver", "session_events", "fct_sessions"}
    assert suites_of() == gold | {"silver", "session_events", "fct_sessions", "bronze"}
    short = gate.validate({**clean, "bronze": clean["bronze"].limit(1)}, gold_only=True)
    assert failing(short) == set()


def test_summary_document(spark, clean, tmp_path):
    at = F.lit("2020-01-01 00:00:00").cast("timestamp")
    assert gate.write_summary(gate.validate(clean), str(tmp_path / "ok.json"), at) == "PASS"
    broken = {**clean, "silver": one_row(clean["silver"], "event_id", "price", "-1")}
    assert gate.write_summary(gate.validate(broken), str(tmp_path / "bad.json"), at) == "FAIL"
    files = list((tmp_path / "bad.json").glob("*.json"))
    document = json.loads(files[0].read_text())
    assert len(files) == 1 and set(document) == {"generated_at", "overall_status", "checks"}
    assert document["generated_at"] == "2020-01-01T00:00:00Z"
    by_name = {c["name"]: c for c in document["checks"]}
    assert by_name["silver"] == {"name": "silver", "status": "FAIL", "details": ["negative_price: 1"]}
    assert by_name["bronze"] == {"name": "bronze", "status": "PASS", "details": ["ok"]}


def test_sample_file(spark):
    names = S.PAYLOAD.names

    def sample(**changes):
        rows = [{**{n: "1" for n in names}, "event_id": str(i), "event_type": "view",
                 "event_time": "2019-10-01 00:00:00 UTC"} for i in range(3)]
        rows[0].update(changes)
        return make(spark, S.SAMPLE_CSV, rows)

    def found(expected_rows=3, **changes):
        return {c for _, c in failing(suites.sample_file(sample(**changes), expected_rows))}

    assert found() == found(event_time="2019-10-01 00:00:00") == found(event_time="2019-1-1 0:0:0 UTC") == set()
    assert found(price="n/a") == found(price=None) == found(event_id=None) == set()
    assert found(4) == {"expected_rows"}
    assert found(event_id="2") == {"duplicate_event_id"}
    assert found(event_type=None) == {"invalid_event_type"}
    assert found(event_time="soon") == found(event_time=None) == {"unparseable_event_time"}
    assert found(price="-0.5") == {"negative_price"}
    twice = sample(event_id=None).unionByName(sample(event_id="").limit(1))
    assert {c for _, c in failing(suites.sample_file(twice, 4))} >= {"duplicate_event_id"}
    assert failing(suites.sample_file(sample().drop("brand"), 3)) == {("sample", "required_columns")}


def test_structure(clean):
    assert failing(gate.bronze_structure(clean["bronze"], 6)) == set()
    assert failing(gate.bronze_structure(clean["bronze"])) == {("bronze_structure", "min_rows")}
    bare = clean["bronze"].drop("kafka_offset", "ingested_at")
    got = {r.check: r.violations for r in gate.bronze_structure(bare, 6, quarantine=bare).collect()}
    assert (got["topic_columns"], got["quarantined_rows"]) == (2, 6)
    assert failing(gate.silver_structure(clean["silver"], clean["bronze"], 5)) == set()
    found = failing(gate.silver_structure(clean["silver"], clean["bronze"].limit(1), 9))
    assert {c for _, c in found} == {"min_rows", "rows_within_bronze"}


def test_milestones(clean):
    expected = {
        "bronze_rows": (6, 0), "silver_rows": (6, 0), "fct_sessions": (4, 2), "fct_purchases": (1, 0),
        "agg_product_performance": (2, 0), "fct_cart_abandonment": (1, 0), "total_revenue": (5.5, 1.0),
    }
    got = {r.metric: (r.actual, r.delta, r.status) for r in gate.milestones(clean, expected).collect()}
    assert got["silver_rows"] == (5.0, 1.0, "DRIFT")
    assert got["fct_sessions"] == (2.0, 2.0, "ok")
    assert got["total_revenue"] == (5.0, 0.5, "ok")
    assert {r.metric for r in gate.milestones(clean).collect()} == set(S.MILESTONES)


@pytest.fixture(scope="module")
def relations(clean):
    staged = models.staging({n: clean[n] for n in S.GOLD})
    return {**clean, **staged, **models.marts(staged)}


def test_column_tests_pass_and_are_all_there(relations):
    got = column_tests(relations).collect()
    assert len(got) == 43 and {r.status for r in got} == {"PASS"}
    assert len({(r.relation, r.column_name, r.test) for r in got}) == 43


@pytest.mark.parametrize(
    "relation, key, column, value, test, failures",
    [
        ("fct_sessions", "session_id", "session_revenue", "NULL", "not_null", 1),
        ("fct_sessions", "session_id", "session_id", "'s2'", "unique", 1),
        ("stg_fct_purchases", "purchase_id", "purchase_amount", "NULL", "not_null", 1),
        ("mart_conversion_funnel", "session_date", "session_date", "'2019-10-02'", "unique", 1),
        ("fct_cart_abandonment", "session_id", "abandoned", "false", "accepted_values", 1),
        ("fct_cart_abandonment", "session_id", "abandoned", "NULL", "not_null", 1),
    ],
)
def test_column_tests_fail_alone(relations, relation, key, column, value, test, failures):
    broken = {relation: one_row(relations[relation], key, column, value)}
    got = [r for r in column_tests(broken, {relation: ALL_TESTS[relation]}).collect() if r.status == "FAIL"]
    assert [(r.column_name, r.test, r.failures) for r in got] == [(column, test, failures)]


def test_union_keeps_every_suite(clean):
    both = union_all([suites.check("bronze", suites.BRONZE, clean), suites.check("silver", suites.SILVER, clean)])
    assert both.select("suite").distinct().count() == 2
