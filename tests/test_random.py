"""Random bronze rows, dirty in every way, through Spark and through SQL.

Unlike the test tables these hold sessions shared by users, ids delivered many times, and ties.
"""

import random

import duckdb
import pytest
from builders import event, make, utc

from shoptrail import schemas as S
from shoptrail.operators import carts, funnel, products, purchases, refine, sessionize, sessions
from shoptrail.verify import oracle, registry
from shoptrail.verify.compare import difference


def random_bronze(spark, seed: int):
    dice = random.Random(seed)
    rows = []
    for i in range(600):
        hot = dice.random() < 0.33
        second = dice.choice([0, 0, 0, 1, 59, 3600, 86399, 86400, 90000])
        stamp = utc("2019-10-01T00:00:00").timestamp() + second
        moment = utc("1970-01-01T00:00:00").fromtimestamp(stamp, tz=utc("1970-01-01T00:00:00").tzinfo)
        rows.append(
            event(
                i,
                event_id="hot" if dice.random() < 0.05 else dice.choice([f"e{dice.randrange(400):03d}"] * 9 + ["", " "]),
                event_time=moment.strftime("%Y-%m-%d %H:%M:%S") + dice.choice([" UTC", " UTC", ""]),
                event_type=dice.choice(S.EVENT_TYPES),
                product_id=None if dice.random() < 0.03 else dice.randrange(6),
                category_id=dice.choice(["1", "22", "n/a", None]),
                category_code=dice.choice([" a", "b ", " ", None]),
                brand=dice.choice(["X ", "y", "", None]),
                price=dice.choice([None, 0.0, 1.25, 3.5, -1.0]),
                user_id=None if dice.random() < 0.03 else dice.randrange(5),
                user_session="big" if hot else dice.choice([f"s{dice.randrange(60)}"] * 9 + [" ", None]),
                event_date=moment.date(),
                kafka_partition=dice.choice([0, 1, None]),
                kafka_offset=i,
                kafka_topic="t",
                ingested_at=utc("2020-01-01T00:00:00"),
            )
        )
    return make(spark, S.BRONZE, rows)


def sql(monkeypatch, bronze, layer: str, columns: str):
    monkeypatch.setitem(oracle._LAYERS, "bronze", ([], "SELECT * FROM given"))
    db = duckdb.connect()
    db.register("given", bronze.drop("ingested_at").toArrow())
    return db.sql(oracle.over(layer, f"SELECT {columns} FROM {layer}")).to_arrow_table()


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("heavy", [[], ["big"]])
def test_all_layers(spark, monkeypatch, seed, heavy):
    bronze = random_bronze(spark, seed).cache()
    silver = refine.to_silver(bronze).cache()
    events = sessionize.order_sessions(silver, heavy_sessions=heavy).cache()
    facts = sessions.session_facts(silver)
    built = {
        "silver": (silver, S.SILVER),
        "session_events": (events, S.SESSION_EVENTS),
        "fct_sessions": (facts, S.FCT_SESSIONS),
        "fct_purchases": (purchases.purchase_facts(events), S.FCT_PURCHASES),
        "agg_product_performance": (products.product_performance(events), S.AGG_PRODUCT_PERFORMANCE),
        "agg_conversion_funnel": (funnel.conversion_funnel(funnel.session_flags(events)), S.AGG_CONVERSION_FUNNEL),
        "fct_cart_abandonment": (carts.cart_abandonment(facts, carts.cart_details(events)), S.FCT_CART_ABANDONMENT),
    }
    assert facts.groupBy("session_id").count().where("count > 1").count() > 3
    for name, (frame, schema) in built.items():
        wanted = sql(monkeypatch, bronze, name, registry._columns(schema))
        got = registry._comparable(frame).toArrow()
        assert got.num_rows > 0 and difference(got, wanted) is None, name
