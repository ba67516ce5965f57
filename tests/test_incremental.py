"""Days brought up to date one after the other against a build of everything."""

import pytest
from pyspark.sql import functions as F

from builders import event, records
from shoptrail import schemas as S
from shoptrail.__main__ import main
from shoptrail.plans import incremental, medallion
from shoptrail.plans.medallion import Lake
from shoptrail.sources.layers import read_layer

CLOCKS = {"ingested_at", "bronze_ingested_at", "silver_processed_at", "sessionized_at", "gold_processed_at"}


def send(spark, lake, payloads, first_offset=0):
    records(spark, payloads, first_offset).coalesce(1).write.mode("append").parquet(f"{lake.root}/topic")


def stream(spark, lake):
    return spark.readStream.schema(S.ENVELOPE).parquet(f"{lake.root}/topic")


def contents(spark, lake):
    places = {"silver": (lake.silver, S.SILVER), "session_events": (lake.session_events, S.SESSION_EVENTS)}
    places |= {name: (lake.gold_table(name), schema) for name, (schema, _) in S.GOLD.items()}
    found = {}
    for name, (path, schema) in places.items():
        columns = [c for c in schema.names if c not in CLOCKS]
        found[name] = sorted(map(str, read_layer(spark, path, schema).select(columns).collect()))
    return found


def first_days():
    kinds = ["view", "cart", "view", "purchase", "cart"]
    return [
        event(i, event_time=f"2019-10-{1 + i // 10:02d} {23 if i % 10 > 4 else 1}:{i % 60:02d}:00 UTC", event_type=kinds[i % 5],
              user_session=f"s{i // 3}", user_id=i // 3, product_id=i % 4)
        for i in range(40)
    ]


def late():
    """A session's earlier start, an id delivered again on another day, a new day."""
    return [
        event(100, event_time="2019-10-01 22:00:00 UTC", user_session="s12", user_id=12, event_type="cart"),
        event(5, event_time="2019-10-03 05:00:00 UTC", user_session="s1", user_id=1),
        event(101, event_time="2019-10-09 05:00:00 UTC", user_session="new", user_id=99, event_type="purchase"),
    ]


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    lake = Lake(str(tmp_path_factory.mktemp("whole")))
    send(spark, lake, first_days())
    send(spark, lake, late(), 1000)
    medallion.ingest(stream(spark, lake), lake, query_name="inc_whole")
    medallion.build_silver(spark, lake)
    medallion.build_gold(spark, lake)
    return contents(spark, lake)


def test_second_run_updates_touched_days(spark, tmp_path, whole):
    lake = Lake(str(tmp_path))
    send(spark, lake, first_days())
    assert medallion.run(spark, lake, stream(spark, lake), query_name="inc_a")["status"] == "PASS"
    send(spark, lake, late(), 1000)
    report = medallion.run(spark, lake, stream(spark, lake), query_name="inc_b")
    assert report["status"] == "PASS" and len(report["silver"]) >= 3
    assert contents(spark, lake) == whole
    assert medallion.pending_days(spark, lake) == []
    # Nothing new: nothing is written.
    assert medallion.run(spark, lake, stream(spark, lake), query_name="inc_c")["silver"] == []
    assert contents(spark, lake) == whole


def test_ranges_one_after_the_other_and_appending_again(spark, tmp_path, whole):
    lake = Lake(str(tmp_path))
    send(spark, lake, first_days())
    send(spark, lake, late(), 1000)
    medallion.ingest(stream(spark, lake), lake, query_name="inc_d")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert main(["update", "--lake", lake.root, "--until", "2019-10-02"], spark) == 0
    assert main(["update", "--lake", lake.root, "--since", "2019-10-03"], spark) == 0
    assert contents(spark, lake) == whole
    assert main(["gold", "--lake", lake.root, "--mode", "append"], spark) == 0
    assert contents(spark, lake) == whole
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_an_emptied_day_is_removed(spark, tmp_path):
    frame = spark.createDataFrame([(1, "2019-10-01"), (2, "2019-10-02")], "n int, day string").withColumn("day", F.col("day").cast("date"))
    days = incremental.days_between(frame, None, None, "day")
    incremental.replace_days(frame, f"{tmp_path}/t", "day", days)
    incremental.replace_days(frame.where("n = 2"), f"{tmp_path}/t", "day", days)
    assert [row.n for row in spark.read.parquet(f"{tmp_path}/t").collect()] == [2]


def test_reset_needs_a_start_at_the_earliest(spark, tmp_path):
    with pytest.raises(SystemExit):
        main(["run", "--lake", str(tmp_path), "--files", str(tmp_path), "--start", "latest", "--reset"], spark)
