from collections import Counter

import pytest

from shoptrail import schemas as S
from shoptrail.operators import sampling


def source(spark, rows: int, alike: int = 0):
    frame = spark.range(rows).selectExpr(
        "concat('t', id) AS event_time", "'view' AS event_type", "CAST(id AS STRING) AS product_id",
        "CAST(NULL AS STRING) AS category_id", "'' AS category_code", "'b' AS brand", "'1' AS price",
        "'7' AS user_id", "'s' AS user_session",
    )
    if alike:
        copies = frame.where("product_id = '0'").selectExpr("*", f"explode(sequence(1, {alike})) AS i").drop("i")
        frame = frame.where("product_id != '0'").unionByName(copies)
    return frame


def picked(sample):
    return Counter(r.product_id for r in sample.rows.collect())


def test_exact_size_same_seed_and_layout(spark):
    frame = source(spark, 5000)
    first = sampling.fixed_size_sample(frame, 700, 1)
    assert (first.rows.count(), first.scanned, first.short) == (700, 5000, False)
    again = sampling.fixed_size_sample(frame.repartition(7, "event_time"), 700, 1)
    assert picked(first) == picked(again)
    assert picked(first) != picked(sampling.fixed_size_sample(frame, 700, 2))
    assert max(picked(first).values()) == 1


def test_source_smaller_than_sample(spark):
    sample = sampling.fixed_size_sample(source(spark, 20), 50)
    assert (sample.rows.count(), sample.scanned, sample.short) == (20, 20, True)


@pytest.mark.parametrize("n", [0, -1])
def test_size_must_be_positive(spark, n):
    with pytest.raises(ValueError):
        sampling.fixed_size_sample(source(spark, 5), n)


def test_copies_are_units_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(sampling, "_COPIES_PER_STEP", 7)
    frame = source(spark, 201, alike=100)
    assert picked(sampling.fixed_size_sample(frame, 300))["0"] == 100
    third = picked(sampling.fixed_size_sample(frame, 150))
    assert sum(third.values()) == 150
    assert 30 <= third["0"] <= 70


def test_share_is_uniform(spark):
    got = picked(sampling.fixed_size_sample(source(spark, 4000), 1000))
    assert 400 <= sum(1 for p in got if int(p) < 2000) <= 600


def test_ids_are_sequential_and_blanks_filled(spark):
    sample = sampling.fixed_size_sample(source(spark, 3000), 1234, seed=9)
    stamped = sampling.stamp_event_ids(sample.rows.drop("brand"), seed=9)
    assert stamped.schema.names == S.SAMPLE_CSV.names
    rows = stamped.collect()
    assert sorted(r.event_id for r in rows) == [f"evt_9_{i:010d}" for i in range(1, 1235)]
    assert {r.brand for r in rows} == {r.category_id for r in rows} == {""}
    keyed = [r.product_id for r in sample.rows.orderBy("sample_key").collect()]
    assert [r.product_id for r in sorted(rows, key=lambda r: r.event_id)] == keyed


def test_sample_ignores_layout(spark):
    frame = source(spark, 500)
    assert picked(sampling.fixed_size_sample(frame, 60)) == picked(sampling.fixed_size_sample(frame.coalesce(1), 60))


@pytest.mark.parametrize("n", [5, 20, 200_000])
def test_rows_without_position_come_last(spark, n):
    frame = spark.range(30).selectExpr("IF(id % 3 = 0, NULL, id) AS position")
    got = [r.position for r in sampling.first_rows(frame, n, "position").collect()]
    assert got == ([i for i in range(30) if i % 3] + [None] * 10)[:n]


def test_first_rows(spark):
    frame = spark.range(1000).selectExpr("id * 3 AS position").repartition(5)
    got = sorted(r.position for r in sampling.first_rows(frame, 100, "position").collect())
    assert got == [i * 3 for i in range(100)]
