"""Rows of the layers, made by hand."""

import datetime as dt
import json

from shoptrail import schemas as S


def utc(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


def make(spark, schema, rows: list[dict]):
    """Rows given by name; absent columns are NULL."""
    names = schema.names
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


def event(number: int, **changes) -> dict:
    """A payload that every layer accepts."""
    row = {
        "event_id": f"e{number:03d}",
        "event_time": "2019-10-01 00:00:00 UTC",
        "event_type": "view",
        "product_id": 1,
        "category_id": "205",
        "category_code": "cat.one",
        "brand": "acme",
        "price": 10.0,
        "user_id": 7,
        "user_session": "s1",
    }
    return {**row, **changes}


def records(spark, payloads, first_offset: int = 0):
    """Topic records; a payload is a dict, or text taken as it is, or None."""
    rows = [
        {
            "topic": "t",
            "partition": 0,
            "offset": first_offset + i,
            "timestamp": utc("2019-10-01T00:00:00"),
            "key": "k",
            "value": json.dumps(p) if isinstance(p, dict) else p,
        }
        for i, p in enumerate(payloads)
    ]
    return make(spark, S.ENVELOPE, rows)


def silver_rows(spark, rows: list[dict]):
    base = {"event_type": "view", "product_id": 1, "price": 10.0, "user_id": 7, "user_session": "s1"}
    filled = []
    for i, row in enumerate(rows):
        full = {"event_id": f"e{i:03d}", **base, **row}
        full["event_ts"] = utc(full.get("at", "2019-10-01T00:00:00"))
        full["event_date"] = full["event_ts"].date()
        filled.append(full)
    return make(spark, S.SILVER, filled)
