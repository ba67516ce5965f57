import pytest
from builders import event, records

from shoptrail.operators import validity


def judged(spark, payloads):
    rows = validity.judge(records(spark, payloads)).orderBy("kafka_offset").collect()
    return [r.asDict() for r in rows]


@pytest.mark.parametrize(
    "payload, reason",
    [
        (event(1), None),
        (event(1, event_id=None), "missing_event_id"),
        (event(1, event_id=None, event_time=None, event_type="x"), "missing_event_id"),
        (event(1, event_time=None, event_type="x"), "missing_event_time"),
        (event(1, event_type="error"), "invalid_event_type"),
        (event(1, event_type="View"), "invalid_event_type"),
        (event(1, event_type="error", event_time="bad"), "invalid_event_type"),
        (event(1, event_time="bad"), "unparseable_event_time"),
        (event(1, event_type=None, event_time="bad"), "unparseable_event_time"),
        (event(1, event_type=None), "missing_event_type"),
        (event(1, event_id=""), None),
        ("{not json", "missing_event_id"),
        (None, "missing_event_id"),
        ("", "missing_event_id"),
        ("[]", "missing_event_id"),
    ],
)
def test_reasons(spark, payload, reason):
    assert judged(spark, [payload])[0]["invalid_reason"] == reason


@pytest.mark.parametrize(
    "text, date",
    [
        ("2019-10-01 00:00:00", "2019-10-01"),
        ("2019-10-01 23:59:59 UTC", "2019-10-01"),
        ("2020-02-29 12:00:00 UTC", "2020-02-29"),
        ("2019-02-29 12:00:00 UTC", None),
        ("2019-10-01 00:00:00 CET", None),
        ("2019-10-01 24:00:00 UTC", None),
        ("2019-10-01T00:00:00", None),
        ("2019-10-01", None),
    ],
)
def test_event_time(spark, text, date):
    got = judged(spark, [event(1, event_time=text)])[0]
    assert (str(got["event_date"]) if got["event_date"] else None) == date
    assert (got["invalid_reason"] is None) == (date is not None)


def test_field_of_wrong_type_is_lost_alone(spark):
    row = judged(spark, [event(1, product_id="abc", price="n/a", category_id=2053, extra=1)])[0]
    assert (row["product_id"], row["price"], row["category_id"]) == (None, None, "2053")
    assert (row["event_id"], row["user_id"], row["invalid_reason"]) == ("e001", 7, None)


def test_no_record_is_lost_and_rejected_text_is_kept(spark):
    payloads = [event(1), "{broken", event(2, event_type=None), event(3, event_type="error"), None]
    frame = validity.judge(records(spark, payloads))
    good, bad = validity.accepted(frame).collect(), validity.rejected(frame).collect()
    assert len(good) == 1 and len(bad) == 4
    assert {r.raw_value for r in bad if r.invalid_reason == "missing_event_id"} == {"{broken", None}
    assert good[0].kafka_offset == 0 and good[0].ingested_at is not None


def test_reason_counts(spark):
    bad = validity.rejected(validity.judge(records(spark, [event(1, event_id=None)] * 3 + [event(2, event_time="x")])))
    got = {r.invalid_reason: r.row_count for r in validity.reason_counts(bad).collect()}
    assert got == {"missing_event_id": 3, "unparseable_event_time": 1}
