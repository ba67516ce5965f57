import random

import pytest
from builders import silver_rows

from shoptrail import schemas as S
from shoptrail.operators import sessionize, sessions, skew


def ordered(spark, rows, **options):
    frame = sessionize.order_sessions(silver_rows(spark, rows), **options)
    return {r.event_id: r for r in frame.collect()}


def test_schema_is_the_contract(spark):
    rows = silver_rows(spark, [{}])
    for frame, schema in (
        (sessionize.order_sessions(rows), S.SESSION_EVENTS),
        (sessions.session_facts(rows), S.FCT_SESSIONS),
    ):
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schema]


def test_single_event(spark):
    row = ordered(spark, [{"at": "2019-10-01T10:00:00"}])["e000"]
    assert (row.event_seq_in_session, row.seconds_from_session_start) == (1, 0)
    assert row.session_start_ts == row.session_end_ts == row.event_ts


def test_same_second_goes_by_id_and_midnight_is_crossed(spark):
    rows = ordered(
        spark,
        [
            {"event_id": "b", "at": "2019-10-01T23:59:59"},
            {"event_id": "a", "at": "2019-10-01T23:59:59"},
            {"event_id": "c", "at": "2019-10-02T00:00:09"},
        ],
    )
    assert [rows[i].event_seq_in_session for i in "abc"] == [1, 2, 3]
    assert [rows[i].seconds_from_session_start for i in "abc"] == [0, 0, 10]
    assert {str(rows[i].event_date) for i in "ac"} == {"2019-10-01", "2019-10-02"}


def shuffled_rows(seed: int):
    """One session with most rows, all but a few of them in one second, and many small ones."""
    dice = random.Random(seed)
    rows = [
        {"event_id": f"h{i:04d}", "user_session": "hot", "at": f"2019-10-01T00:00:{0 if i % 9 else i % 60:02d}"}
        for i in range(400)
    ]
    rows += [
        {"event_id": f"n{i:04d}", "user_session": f"s{i % 37}", "at": f"2019-10-01T00:{i % 60:02d}:00"}
        for i in range(300)
    ]
    dice.shuffle(rows)
    return rows


@pytest.mark.parametrize("heavy", [["hot"], ["hot", "s1"], ["absent"]])
def test_oversized_sessions_are_numbered_like_any_other(spark, heavy):
    rows = shuffled_rows(3)
    plain = ordered(spark, rows, heavy_sessions=[])
    split = ordered(spark, rows, heavy_sessions=heavy)
    fields = ("session_id", "event_seq_in_session", "session_start_ts", "session_end_ts", "seconds_from_session_start")
    assert {k: [v[f] for f in fields] for k, v in split.items()} == {
        k: [v[f] for f in fields] for k, v in plain.items()
    }


def test_oversized_session_is_spread_over_partitions(spark):
    rows = silver_rows(spark, shuffled_rows(5)).where("user_session = 'hot'")
    placed = skew.number_in_slices(rows, "user_session", ["event_ts", "event_id"], "n", {})
    sizes = [len(part) for part in placed.rdd.glom().collect()]
    assert sum(sizes) == 400 and max(sizes) < 400
    assert sorted(r.n for r in placed.collect()) == list(range(1, 401))


def test_heavy_keys_are_found_by_size(spark):
    rows = silver_rows(spark, shuffled_rows(7))
    assert skew.heavy_keys(rows, "user_session", rows=100) == ["hot"]
    assert skew.heavy_keys(rows, "user_session", rows=1000) == []
    every = skew.heavy_keys(rows, "user_session", rows=1)
    assert every[0] == "hot" and len(every) == rows.select("user_session").distinct().where("user_session is not null").count()


def test_all_heavy_keys_are_found(spark):
    rows = spark.range(9_000).selectExpr("id % 3000 AS k")
    assert sorted(skew.heavy_keys(rows, "k", rows=3)) == list(range(3000))


def test_facts(spark):
    facts = sessions.session_facts(
        silver_rows(
            spark,
            [
                {"event_type": "view", "product_id": 1, "at": "2019-10-01T10:00:00"},
                {"event_type": "view", "product_id": 1, "at": "2019-10-01T10:00:05"},
                {"event_type": "view", "product_id": 2, "at": "2019-10-01T10:00:06"},
                {"event_type": "cart", "product_id": 2, "at": "2019-10-01T10:00:07"},
                {"event_type": "remove_from_cart", "product_id": 2, "at": "2019-10-01T10:00:08"},
                {"event_type": "purchase", "product_id": 3, "price": 2.5, "at": "2019-10-01T10:00:09"},
                {"event_type": "purchase", "product_id": 3, "price": None, "at": "2019-10-01T10:01:00"},
            ],
        )
    ).collect()
    assert len(facts) == 1
    row = facts[0]
    assert (row.event_count, row.view_count, row.cart_count) == (7, 3, 1)
    assert (row.remove_from_cart_count, row.purchase_count) == (1, 2)
    assert (row.distinct_products_viewed, row.distinct_products_purchased) == (2, 1)
    assert (row.session_revenue, row.converted, row.session_duration_seconds) == (2.5, True, 60)
    assert str(row.session_date) == "2019-10-01"


def test_session_shared_by_two_users_gives_two_facts(spark):
    rows = [{"user_id": 1}, {"user_id": 2, "event_type": "purchase"}]
    facts = {r.user_id: r for r in sessions.session_facts(silver_rows(spark, rows)).collect()}
    assert {u: (f.event_count, f.converted, f.session_revenue) for u, f in facts.items()} == {
        1: (1, False, 0.0), 2: (1, True, 10.0),
    }
    assert {r.event_seq_in_session for r in ordered(spark, rows).values()} == {1, 2}


def test_processed_at_is_injectable(spark):
    from pyspark.sql import functions as F

    at = F.lit("2020-01-01 00:00:00").cast("timestamp")
    row = sessions.session_facts(silver_rows(spark, [{}]), at).selectExpr("cast(gold_processed_at AS string)").first()
    assert row[0] == "2020-01-01 00:00:00"
