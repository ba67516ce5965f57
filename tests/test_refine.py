import pytest
from builders import event, make, utc

from shoptrail import schemas as S
from shoptrail.operators import refine


def bronze(spark, rows):
    filled = []
    for row in rows:
        full = {**event(1), "kafka_partition": 0, "kafka_offset": 0, "ingested_at": utc("2020-01-01T00:00:00"), **row}
        if "event_date" not in row:
            full["event_date"] = utc("2019-10-01T00:00:00").date()
        filled.append(full)
    return make(spark, S.BRONZE, filled)


def silver(spark, rows):
    return refine.to_silver(bronze(spark, rows)).collect()


def test_schema_is_the_contract(spark):
    frame = refine.to_silver(bronze(spark, [{}]))
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in S.SILVER]


@pytest.mark.parametrize(
    "given, kept",
    [
        ({"category_id": "n/a"}, {"category_id": None}),
        ({"category_id": "2053013555631882655"}, {"category_id": 2053013555631882655}),
        ({"category_code": "  "}, {"category_code": None}),
        ({"category_code": " Cat.A "}, {"category_code": "Cat.A"}),
        ({"brand": " ACME Inc "}, {"brand": "acme inc"}),
        ({"brand": ""}, {"brand": None}),
        ({"price": None}, {"price": None}),
        ({"price": 0.0}, {"price": 0.0}),
    ],
)
def test_cleaning(spark, given, kept):
    row = silver(spark, [given])[0].asDict()
    assert {k: row[k] for k in kept} == kept


@pytest.mark.parametrize(
    "given",
    [
        {"event_id": ""}, {"event_id": "  "}, {"event_id": None}, {"event_type": "error"},
        {"event_type": None}, {"event_time": "bad"}, {"event_date": None}, {"product_id": None},
        {"user_id": None}, {"user_session": None}, {"user_session": " "}, {"price": -0.01},
    ],
)
def test_dropped(spark, given):
    assert silver(spark, [given]) == []


def test_nan_price_survives(spark):
    assert len(silver(spark, [{"price": float("nan")}])) == 1


@pytest.mark.parametrize(
    "deliveries, winner",
    [
        # (partition, offset, hour of ingest); the partition outranks the offset
        ([(1, 5, 0), (2, 1, 0)], 1),
        ([(1, 5, 0), (1, 7, 0)], 1),
        ([(1, 5, 3), (1, 5, 1)], 0),
        ([(None, 99, 9), (0, 0, 0)], 1),
        ([(0, None, 9), (0, 0, 0)], 1),
    ],
)
def test_latest_delivery_wins(spark, deliveries, winner):
    rows = [
        {"kafka_partition": p, "kafka_offset": o, "ingested_at": utc(f"2020-01-01T0{h}:00:00"), "price": float(i)}
        for i, (p, o, h) in enumerate(deliveries)
    ]
    assert [r.price for r in silver(spark, rows)] == [float(winner)]
    assert [r.price for r in silver(spark, rows[::-1])] == [float(winner)]


def test_full_tie_is_settled_the_same_way(spark):
    rows = [{"price": float(i)} for i in range(20)]
    assert silver(spark, rows)[0].price == silver(spark, rows[::-1])[0].price


def test_an_ineligible_later_delivery_does_not_hide_an_earlier_one(spark):
    rows = [{"kafka_offset": 1, "price": 5.0}, {"kafka_offset": 2, "price": -1.0}]
    assert [r.price for r in silver(spark, rows)] == [5.0]
