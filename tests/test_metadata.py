"""What is kept beside the layers: key sketches, day indexes, product state, the log of batches."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from builders import event, records, silver_rows
from shoptrail import schemas as S
from shoptrail.operators import products, sessionize
from shoptrail.plans import incremental, medallion
from shoptrail.plans.key_days import KeyDays
from shoptrail.plans.medallion import Lake
from shoptrail.sources import sketches
from shoptrail.sources.batches import BatchLog, folder_of
from shoptrail.sources.layers import read_layer, write_layer


def stream(spark, lake):
    return spark.readStream.schema(S.ENVELOPE).parquet(f"{lake.root}/topic")


def send(spark, lake, payloads, first_offset=0):
    records(spark, payloads, first_offset).coalesce(1).write.mode("append").parquet(f"{lake.root}/topic")


def shop_events(days=4, per_day=12, first=0):
    kinds = ["view", "cart", "view", "purchase"]
    return [
        event(first + d * per_day + i, event_time=f"2019-10-{d + 1:02d} 0{i % 9}:00:00 UTC", event_type=kinds[i % 4],
              user_session=f"d{d}s{i // 4}", user_id=i // 4, product_id=i % 5, price=1.5)
        for d in range(days) for i in range(per_day)
    ]


def rows_of(df):
    clocks = {"ingested_at", "bronze_ingested_at", "silver_processed_at", "sessionized_at", "gold_processed_at"}
    return sorted(map(str, df.select(*[c for c in df.columns if c not in clocks]).collect()))


def test_frequent_keys_are_noted_while_writing(spark, tmp_path):
    rows = silver_rows(spark, [{"event_id": f"h{i}", "user_session": "hot" if i % 3 else f"s{i}"} for i in range(600)])
    path = f"{tmp_path}/silver"
    assert sketches.frequent_keys(spark, path, rows, "user_session", 300) == ["hot"]  # nothing noted: counted
    seen = sketches.KeySketch("t1", "user_session", 300)
    write_layer(seen.watch(rows), path, "event_date")
    seen.keep(path, replace=True)
    layer = read_layer(spark, path, S.SILVER)
    assert layer.count() == 600
    assert sketches.frequent_keys(spark, path, layer.where("false"), "user_session", 300) == ["hot"]
    assert sketches.frequent_keys(spark, path, layer, "user_session", 401) == []
    more = sketches.KeySketch("t2", "user_session", 300)
    more.watch(rows).write.format("noop").mode("overwrite").save()
    more.keep(path, replace=False)
    assert sketches.frequent_keys(spark, path, layer.where("false"), "user_session", 800) == ["hot"]
    nothing = sketches.KeySketch("t3", "user_session", 300)
    nothing.watch(rows.where("event_id = 'none'")).write.format("noop").mode("overwrite").save()
    nothing.keep(path, replace=True)
    assert sketches.frequent_keys(spark, path, layer, "user_session", 1) == []


def test_sketch_of_a_task_stays_small_and_finds_frequent_keys(spark):
    """Each task sends its sketch to the driver, however many keys it has seen."""
    keys = spark.range(0, 300_000, 1, 1).select(F.when(F.col("id") % 100 == 0, "hot").otherwise(F.concat(F.lit("session_"), "id")).alias("key"))
    state = keys.agg(F.expr(f"approx_top_k_accumulate(key, {sketches.TRACKED})").alias("state"))
    assert state.select(F.length("state.sketch")).first()[0] < 200_000
    top = keys.agg(F.expr(f"approx_top_k(key, {sketches.GIVEN}, {sketches.TRACKED})").alias("top")).first()["top"]
    assert top[0]["item"] == "hot" and abs(top[0]["count"] - 3_000) <= 3.5 * 300_000 / sketches.TRACKED


def test_ordering_sessions_starts_no_job(spark):
    rows = silver_rows(spark, [{"event_id": f"h{i}"} for i in range(10)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        sessionize.order_sessions(rows)
        assert not tracker.getJobIdsForGroup("planning")
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_index_of_days(spark, tmp_path):
    rows = spark.createDataFrame([("a", "2019-10-01"), ("a", "2019-10-03"), ("b", "2019-10-02"), (None, "2019-10-04"), ("c", "2019-10-05"), ("c", "2019-10-01")], "key string, day string")
    rows = rows.withColumn("day", F.col("day").cast("date"))
    index = KeyDays(f"{tmp_path}/index")
    assert not index.known(spark)
    index.build(rows)
    day = {int(str(r.day)[-2:]): r.day for r in rows.select("day").distinct().collect()}
    assert index.known(spark)
    assert index.others(spark.createDataFrame([("a",), (None,)], "key string"), [day[1]]) == [day[3]]
    assert index.others(spark.createDataFrame([("a",), ("c",), ("x",)], "key string"), []) == [day[1], day[3], day[5]]
    index.note(rows.where("key = 'b'"), [day[1], day[2], day[3]])
    assert index.others(spark.createDataFrame([("a",), ("b",), ("c",)], "key string"), []) == [day[2], day[5]]


def _spoil(folder):
    """Make every data file below a folder unreadable."""
    found = glob.glob(f"{folder}/**/*.parquet", recursive=True)
    assert found
    for path in found:
        with open(path, "wb") as out:
            out.write(b"no parquet")


def test_untouched_days_are_not_read(spark, tmp_path):
    lake = Lake(str(tmp_path))
    send(spark, lake, shop_events())
    medallion.run(spark, lake, stream(spark, lake), query_name="meta_a")
    # The first update builds indexes and state.
    send(spark, lake, [event(900, event_time="2019-10-02 05:00:00 UTC", user_session="d1s0", user_id=0)], 1000)
    medallion.ingest(stream(spark, lake), lake, query_name="meta_b")
    incremental.update(spark, lake, medallion.pending_days(spark, lake))
    late = [event(901, event_time="2019-10-03 05:00:00 UTC", user_session="d2s1", user_id=1, event_type="purchase", product_id=3, price=2.5)]
    send(spark, lake, late, 2000)
    medallion.ingest(stream(spark, lake), lake, query_name="meta_c")
    for folder in (f"{lake.bronze}/*/*", lake.silver, lake.session_events, lake.gold_table("fct_sessions")):
        for column in ("event_date", "session_date"):
            for path in glob.glob(f"{folder}/{column}=2019-10-01"):
                _spoil(path)
    days = [d for d in medallion.pending_days(spark, lake) if d.day == 3]
    written = incremental.update(spark, lake, days)
    assert [str(d) for d in written["gold"]] == ["2019-10-03"]
    facts = read_layer(spark, lake.gold_table("agg_product_performance"), S.AGG_PRODUCT_PERFORMANCE)
    sent = shop_events() + [event(900, event_time="2019-10-02 05:00:00 UTC", user_session="d1s0", user_id=0)] + late
    assert facts.agg(F.sum("purchase_count"), F.sum("total_revenue")).first()[:] == (
        sum(e["event_type"] == "purchase" for e in sent), sum(e["price"] for e in sent if e["event_type"] == "purchase"))


def test_product_state_equals_a_build(spark, tmp_path):
    lake = Lake(str(tmp_path))
    send(spark, lake, shop_events(3))
    medallion.run(spark, lake, stream(spark, lake), query_name="prod_a")
    table = lake.gold_table("agg_product_performance")
    for turn, extra in enumerate((
        [event(700, event_time="2019-10-02 01:00:00 UTC", product_id=2, event_type="purchase", user_id=5, user_session="x1", brand="zeta", price=2.5)],
        [event(701, event_time="2019-10-07 01:00:00 UTC", product_id=77, user_id=1, user_session="x2"), event(700, event_time="2019-10-01 01:00:00 UTC", product_id=1, user_id=8, user_session="x3")],
    )):
        send(spark, lake, extra, 3_000 + turn)
        medallion.run(spark, lake, stream(spark, lake), query_name=f"prod_{turn}")
        events = read_layer(spark, lake.session_events, S.SESSION_EVENTS)
        assert rows_of(spark.read.schema(S.AGG_PRODUCT_PERFORMANCE).parquet(table)) == rows_of(products.product_performance(events))


def test_what_another_ingest_notes_meanwhile_stays(spark, tmp_path, monkeypatch):
    lake = Lake(str(tmp_path))
    send(spark, lake, shop_events(2))
    medallion.run(spark, lake, stream(spark, lake), query_name="race_a")
    send(spark, lake, [event(800, event_time="2019-10-01 05:00:00 UTC")], 4_000)
    update = incremental.update

    def slow(*args, **options):
        done = update(*args, **options)
        send(spark, lake, [event(801, event_time="2019-10-02 05:00:00 UTC")], 5_000)
        medallion.ingest(stream(spark, lake), lake, query_name="race_b")
        return done

    monkeypatch.setattr(incremental, "update", slow)
    medallion.run(spark, lake, stream(spark, lake), query_name="race_c")
    assert [str(d) for d in medallion.pending_days(spark, lake)] == ["2019-10-02"]
    monkeypatch.setattr(incremental, "update", update)
    medallion.run(spark, lake, stream(spark, lake), query_name="race_d")
    assert medallion.pending_days(spark, lake) == []
    assert read_layer(spark, lake.silver, S.SILVER).where("event_id = 'e801'").count() == 1


@pytest.fixture
def batches(spark, tmp_path):
    """Three committed batches of a sink."""
    lake = Lake(str(tmp_path))
    for i in range(3):
        send(spark, lake, shop_events(2, 6, first=100 * i) + [event(500 + i, event_time="never")], 1_000 * i)
        medallion.ingest(stream(spark, lake), lake, query_name="log")
    return lake


def test_compaction_keeps_rows(spark, batches):
    lake, log = batches, BatchLog(spark, batches.bronze)
    before, bad = rows_of(medallion.read_bronze(spark, lake)), rows_of(medallion.read_quarantine(spark, lake))
    assert len(log.folders()) == 3 and len(before) == 36 and len(bad) == 3
    assert medallion.compact(spark, lake) == {"bronze": {"before": 3, "after": 1}, "quarantine": {"before": 3, "after": 1}}
    assert rows_of(medallion.read_bronze(spark, lake)) == before and rows_of(medallion.read_quarantine(spark, lake)) == bad
    assert rows_of(read_layer(spark, lake.bronze, S.BRONZE)) == before  # nothing else is left in the folder
    assert medallion.compact(spark, lake)["bronze"] == {"before": 1, "after": 1}
    send(spark, lake, shop_events(1, 4, first=900), 9_000)
    medallion.ingest(stream(spark, lake), lake, query_name="log")
    medallion.compact(spark, lake)
    assert len(rows_of(medallion.read_bronze(spark, lake))) == 40 and len(log.folders()) == 1
    assert set(medallion.read_tables(spark, lake)["bronze"].columns) >= set(S.BRONZE.names) if os.path.exists(lake.silver) else True


@pytest.mark.parametrize("step", ["written", "committed"])
def test_compaction_after_a_crash(spark, batches, step, monkeypatch):
    """A crash behind the write leaves the batches, one behind the commit leaves the new folder; neither shows rows twice."""
    lake, log = batches, BatchLog(spark, batches.bronze)
    before = rows_of(medallion.read_bronze(spark, lake))
    with monkeypatch.context() as broken:
        def crash(*_):
            raise RuntimeError("lost")

        if step == "written":
            broken.setattr(BatchLog, "_put", crash)
        else:
            cleaned = []
            real = BatchLog.clean
            broken.setattr(BatchLog, "clean", lambda self: crash() if cleaned else (cleaned.append(1), real(self)))
        with pytest.raises(RuntimeError):
            log.compact(S.BRONZE, ("event_date", "event_type"))
    assert rows_of(medallion.read_bronze(spark, lake)) == before
    log.compact(S.BRONZE, ("event_date", "event_type"))
    log.clean()
    assert rows_of(medallion.read_bronze(spark, lake)) == before
    assert rows_of(read_layer(spark, lake.bronze, S.BRONZE)) == before


def test_a_replayed_batch_does_not_come_back(spark, batches):
    lake, log = batches, BatchLog(spark, batches.bronze)
    last = max(log.folders(), key=lambda f: int(f.rsplit("=", 1)[1]))
    rows = read_layer(spark, f"{lake.bronze}/{last}", S.BRONZE).cache()
    before = rows_of(medallion.read_bronze(spark, lake))
    rows.count()
    log.compact(S.BRONZE, ("event_date", "event_type"))
    run, batch = last.split("/")[0].split("=")[1], int(last.rsplit("=", 1)[1])
    write_layer(rows, f"{lake.bronze}/{folder_of(run, batch)}", ("event_date", "event_type"))
    log.commit(run, batch)
    assert rows_of(medallion.read_bronze(spark, lake)) == before


def test_folders_from_before_the_log_are_taken_in(spark, batches):
    log = BatchLog(spark, batches.bronze)
    before = rows_of(medallion.read_bronze(spark, batches))
    log.forget()
    assert log.folders() is None and rows_of(medallion.read_bronze(spark, batches)) == before
    send(spark, batches, shop_events(1, 4, first=900), 9_000)
    medallion.ingest(stream(spark, batches), batches, query_name="log")
    assert len(log.folders()) == 4 and len(rows_of(medallion.read_bronze(spark, batches))) == 40
