import pytest
from builders import silver_rows

from shoptrail import schemas as S
from shoptrail.operators import carts, funnel, models, products, purchases, report, sessionize, sessions


def session_events(spark, rows):
    return sessionize.order_sessions(silver_rows(spark, rows))


def steps(*kinds, session="s1", day="2019-10-01"):
    return [
        {"event_id": f"{session}{day}{i}", "event_type": kind, "user_session": session, "at": f"{day}T00:00:{i:02d}"}
        for i, kind in enumerate(kinds)
    ]


@pytest.mark.parametrize(
    "kinds, expected",
    [
        # view->cart, cart->purchase, view->purchase, abandoned
        (["cart", "view"], (False, False, False, True)),
        (["view", "purchase", "cart"], (True, False, True, False)),
        (["view", "cart", "purchase"], (True, True, True, False)),
        (["purchase"], (False, False, False, False)),
        (["cart", "remove_from_cart"], (False, False, False, True)),
        (["view"], (False, False, False, False)),
        (["cart", "view", "cart", "purchase", "view"], (False, True, True, False)),
    ],
)
def test_order_of_first_steps(spark, kinds, expected):
    row = funnel.session_flags(session_events(spark, steps(*kinds))).first()
    assert (
        row.has_strict_view_to_cart, row.has_strict_cart_to_purchase,
        row.has_strict_view_to_purchase, row.is_cart_abandoned,
    ) == expected
    assert (row.has_view, row.has_cart, row.has_purchase) == tuple(
        int(k in kinds) for k in ("view", "cart", "purchase")
    )


def test_daily_funnel(spark):
    rows = (
        steps("view", "cart", "purchase", session="a")
        + steps("view", "cart", session="b")
        + steps("purchase", session="c")
        + steps("view", session="d", day="2019-10-02")
    )
    days = {str(r.session_date): r for r in funnel.conversion_funnel(
        funnel.session_flags(session_events(spark, rows))).collect()}
    first, second = days["2019-10-01"], days["2019-10-02"]
    assert (first.total_sessions, first.sessions_with_view, first.sessions_with_cart, first.sessions_with_purchase) == (3, 2, 2, 2)
    assert (first.view_to_cart_rate, first.cart_to_purchase_rate, first.cart_abandonment_rate) == (1.0, 0.5, 0.5)
    assert (second.sessions_with_cart, second.cart_to_purchase_rate, second.cart_abandonment_rate) == (0, 0.0, 0.0)


def test_session_belongs_to_its_first_day(spark):
    rows = steps("view") + steps("cart", day="2019-10-02")
    row = funnel.session_flags(session_events(spark, rows)).first()
    assert str(row.session_date) == "2019-10-01"


def test_purchases_keep_missing_amounts(spark):
    rows = [{"event_type": "purchase", "price": None}, {"event_type": "view"}]
    got = purchases.purchase_facts(session_events(spark, rows))
    assert got.schema.names == S.FCT_PURCHASES.names
    assert [(r.purchase_id, r.purchase_amount) for r in got.collect()] == [("e000", None)]


def test_product_performance(spark):
    rows = [
        {"event_type": "view", "user_id": 1, "brand": "b", "category_id": 5},
        {"event_type": "view", "user_id": 1, "brand": "a", "category_id": 9, "category_code": "x"},
        {"event_type": "purchase", "user_id": 2, "price": 3.0},
        {"event_type": "purchase", "user_id": 2, "price": None},
        {"event_type": "purchase", "user_id": 3, "price": 4.0, "at": "2019-10-05T00:00:00"},
        {"event_type": "cart", "user_id": 1, "product_id": 2},
        {"event_type": "cart", "user_id": 2, "product_id": 2},
    ]
    got = products.product_performance(session_events(spark, rows))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in S.AGG_PRODUCT_PERFORMANCE]
    one, two = (r for r in got.orderBy("product_id").collect())
    # attributes are taken apart from each other and may come from different rows
    assert (one.category_id, one.category_code, one.brand) == (9, "x", "b")
    assert (one.view_count, one.purchase_count, one.unique_viewers, one.unique_purchasers) == (2, 3, 1, 2)
    assert (one.total_revenue, str(one.last_event_date)) == (7.0, "2019-10-05")
    assert (one.view_to_purchase_rate, one.cart_to_purchase_rate) == (1.0, 0.0)
    assert (two.cart_count, two.unique_cart_adders, two.total_revenue, two.brand) == (2, 2, 0.0, None)


def test_abandonment(spark):
    rows = steps("cart", "cart", session="a") + steps("cart", "purchase", session="b") + steps("view", session="c")
    silver = silver_rows(spark, rows)
    details = carts.cart_details(sessionize.order_sessions(silver))
    got = carts.cart_abandonment(sessions.session_facts(silver), details)
    assert got.schema.names == S.FCT_CART_ABANDONMENT.names
    row = got.collect()
    assert [(r.session_id, r.cart_event_count, r.distinct_products_carted, r.abandoned) for r in row] == [("a", 2, 1, True)]
    assert (row[0].last_cart_ts - row[0].first_cart_ts).total_seconds() == 1


def test_abandonment_without_details_falls_back(spark):
    silver = silver_rows(spark, steps("cart", "cart"))
    none = carts.cart_details(sessionize.order_sessions(silver)).where("false")
    row = carts.cart_abandonment(sessions.session_facts(silver), none).first()
    assert (row.cart_event_count, row.distinct_products_carted, row.first_cart_ts) == (2, None, None)


def test_shared_session_matches_details_for_each_user(spark):
    rows = [{"event_type": "cart", "user_id": 1}, {"event_type": "cart", "user_id": 2}]
    silver = silver_rows(spark, rows)
    got = carts.cart_abandonment(sessions.session_facts(silver), carts.cart_details(sessionize.order_sessions(silver)))
    assert {(r.user_id, r.cart_count, r.cart_event_count) for r in got.collect()} == {(1, 1, 2), (2, 1, 2)}


def test_reports(spark):
    silver = silver_rows(spark, steps("view", "cart") + steps("purchase", session="b"))
    histogram = report.event_type_histogram(silver.unionByName(silver.limit(1).selectExpr("* EXCEPT (event_type)", "CAST(NULL AS STRING) AS event_type")))
    assert [(r.event_type, r.row_count) for r in histogram.collect()] == [("NULL", 1), ("cart", 1), ("purchase", 1), ("view", 1)]
    kpis = report.session_kpis(sessions.session_facts(silver)).first()
    assert (kpis.session_count, kpis.converted_sessions, kpis.total_revenue, kpis.avg_duration_sec, kpis.conversion_rate) == (2, 1, 10.0, 0.5, 0.5)
    empty = report.session_kpis(sessions.session_facts(silver).where("false")).first()
    assert (empty.session_count, empty.conversion_rate) == (0, 0.0)
    total = report.totals(silver, "price", "user_session").first()
    assert (total.row_count, total.total, total.distinct_keys) == (3, 30.0, 2)


def test_top_products_break_ties_by_id(spark):
    mart = spark.createDataFrame(
        [(i, "c", "b", 1, 1, r, 0.0, 0.0) for i, r in [(3, 5.0), (1, 5.0), (2, None), (4, 9.0)]],
        "product_id bigint, category_code string, brand string, purchase_count bigint, "
        "unique_purchasers bigint, total_revenue double, view_to_purchase_rate double, cart_to_purchase_rate double",
    )
    assert [r.product_id for r in report.top_products(mart, 4).collect()] == [4, 1, 3, 2]
    assert report.top_products(mart).count() == 4


def test_marts_are_column_subsets(spark):
    gold = {name: spark.createDataFrame([], schema) for name, (schema, _) in S.GOLD.items()}
    built = models.marts(models.staging(gold))
    assert {n: len(df.columns) for n, df in built.items()} == {
        "mart_sessions": 13, "mart_product_performance": 12, "mart_conversion_funnel": 11,
    }
