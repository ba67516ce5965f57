import json

import pytest
from builders import event, records
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators import models
from shoptrail.plans import medallion
from shoptrail.plans.medallion import Lake
from shoptrail.quality import gate
from shoptrail.sources import load, publish, topic


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """A whole run, from topic files to validated gold."""
    lake = Lake(str(tmp_path_factory.mktemp("run") / "lake"))
    kinds = ["view", "cart", "purchase", "view", "cart", "remove_from_cart"]
    payloads = [
        event(i, event_type=kinds[i % 6], user_session=f"s{i // 3}", user_id=i // 3, product_id=i % 4,
              event_time=f"2019-10-0{1 + i // 20} 00:00:{i % 60:02d} UTC")
        for i in range(60)
    ]
    payloads += payloads[:10] + [event(99, event_type="error"), "{bad"]
    records(spark, payloads).write.parquet(f"{lake.root}/topic")
    report = medallion.run(spark, lake, topic.read_files(spark, f"{lake.root}/topic"))
    return lake, report


def test_run_reports_each_step(finished):
    _, report = finished
    assert report["ingested"] == {"accepted": 70, "rejected": 2}
    assert (report["silver"].rows_read, report["silver"].rows_written, report["silver"].rows_dropped) == (70, 60, 10)
    gold = report["gold"]
    assert (gold["session_events"].rows_read, gold["session_events"].rows_written) == (60, 60)
    assert (gold["fct_sessions"].rows_written, gold["fct_purchases"].rows_written) == (20, 10)
    assert (gold["fct_purchases"].rows_read, gold["agg_product_performance"].rows_written) == (60, 4)
    assert (gold["agg_conversion_funnel"].rows_written, gold["fct_cart_abandonment"].rows_written) == (3, 10)
    assert report["status"] == "PASS"


def test_files_are_few_and_by_date(finished):
    lake, _ = finished
    from pathlib import Path

    files = list(Path(lake.gold, "fct_sessions").rglob("*.parquet"))
    assert {f.parent.name for f in files} == {f"session_date=2019-10-0{d}" for d in (1, 2, 3)}
    assert len(files) == 3


def test_verify_again_and_gold_only(spark, finished):
    lake, _ = finished
    assert medallion.verify(spark, lake) == "PASS"
    assert medallion.verify(spark, lake, min_bronze_rows=1000) == "FAIL"
    assert medallion.verify(spark, lake, gold_only=True) == "PASS"
    assert medallion.verify(spark, lake, skip_bronze=True) == "PASS"


def test_verify_sees_columns_the_files_lack(spark, finished, tmp_path):
    lake, _ = finished
    bare = Lake(str(tmp_path / "lake"))
    for path, name in ((lake.silver, bare.silver), (lake.session_events, bare.session_events)):
        spark.read.parquet(path).write.partitionBy("event_date").parquet(name)
    for table in S.GOLD:
        frame = spark.read.parquet(lake.gold_table(table))
        frame.drop("converted" if table == "fct_sessions" else "x").write.parquet(bare.gold_table(table))
    assert medallion.verify(spark, bare, gold_only=True) == "FAIL"
    document = spark.read.json(bare.summary).selectExpr("inline(checks)").collect()
    assert any("required_columns: 1" in row.details for row in document)


def test_ingest_again_is_incremental_and_silver_unchanged(spark, finished, tmp_path):
    lake, _ = finished
    assert medallion.ingest(topic.read_files(spark, f"{lake.root}/topic"), lake) == {"accepted": 0, "rejected": 0}
    assert medallion.build_silver(spark, lake).rows_written == 60


def test_empty_input_is_refused(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    spark.createDataFrame([], S.BRONZE).write.parquet(lake.bronze)
    with pytest.raises(ValueError, match="no rows in bronze"):
        medallion.build_silver(spark, lake)


@pytest.mark.parametrize("prefix", ["silver", "raw", "", "gold/x", "GOLD"])
def test_only_the_curated_prefix(prefix):
    with pytest.raises(ValueError):
        publish.check_prefix(prefix)


@pytest.mark.parametrize("prefix", ["gold", "/gold/", " gold "])
def test_curated_prefix_is_cleaned(prefix):
    assert publish.check_prefix(prefix) == "gold"


@pytest.mark.parametrize("root", ["/data/silver", "/data/bronze/events", "/data/gold/fct_sessions", "/data/golden", "s3a://b/raw"])
def test_only_the_curated_folder(root):
    with pytest.raises(ValueError):
        publish.check_source(root)


@pytest.mark.parametrize("root", ["/data/gold", "/data/gold/", "s3a://bucket/lake/gold", "/data/raw/gold"])
def test_curated_folder_anywhere(root):
    assert publish.check_source(root) == root.rstrip("/")


def test_inventory_skips_hidden_and_foreign_files(spark, tmp_path):
    root = tmp_path / "gold"
    for name in ("t/a.parquet", "t/d=1/b.parquet", "t/_SUCCESS", "t/.a.parquet.crc", "t/_x.parquet", "t/n.csv", "s.json"):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("1234")
    got = {(r.table_name, r.files, r.bytes) for r in publish.inventory_totals(publish.inventory(spark, str(root))).collect()}
    assert got == {("t", 2, 8), ("s.json", 1, 4)}
    with pytest.raises(FileNotFoundError):
        publish.inventory(spark, str(tmp_path / "nowhere"))


def test_publish_keeps_layout_and_content(spark, finished, tmp_path):
    lake, _ = finished
    target = str(tmp_path / "store")
    planned = publish.publish(spark, lake.gold, target, dry_run=True)
    assert planned["files"] > 5 and not (tmp_path / "store").exists()
    done = publish.publish(spark, lake.gold, target)
    assert done["files"] > 5
    for name in S.GOLD:
        ours, theirs = (spark.read.parquet(f"{root}/{name}") for root in (lake.gold, f"{target}/gold"))
        assert ours.count() == theirs.count() and ours.exceptAll(theirs.select(ours.columns)).isEmpty()
    summary = list((tmp_path / "store/gold/dq_pipeline_summary.json").glob("part-*"))
    assert json.loads(summary[0].read_text())["overall_status"] == "PASS"


def test_publish_refuses_nothing(spark, tmp_path):
    (tmp_path / "gold").mkdir()
    with pytest.raises(ValueError, match="nothing to publish"):
        publish.publish(spark, str(tmp_path / "gold"), str(tmp_path / "store"))


def test_typed_load_takes_the_date_from_the_path(spark, finished):
    lake, _ = finished
    frame = load.typed(spark, lake.gold, "fct_sessions")
    assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in S.FCT_SESSIONS]
    assert {str(r.session_date) for r in frame.select("session_date").distinct().collect()} == {
        "2019-10-01", "2019-10-02", "2019-10-03",
    }
    assert frame.where("session_date != to_date(session_start_ts)").isEmpty()


def test_value_that_does_not_fit_aborts_the_load(spark, finished, tmp_path):
    lake, _ = finished
    good = spark.read.schema(S.AGG_PRODUCT_PERFORMANCE).parquet(f"{lake.gold}/agg_product_performance")
    bad = good.withColumn("view_count", F.lit("many"))
    bad.write.parquet(str(tmp_path / "gold/agg_product_performance"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load.typed(spark, str(tmp_path / "gold"), "agg_product_performance").collect()


def test_serve_end_to_end(spark, finished, tmp_path):
    lake, _ = finished
    served = medallion.serve(spark, lake, str(tmp_path / "store"), "staging_t", "marts_t")
    assert served.tables == [f"marts_t.{name}" for name in S.MARTS]
    tests = served.tests.collect()
    assert len(tests) == 43 and {r.status for r in tests} == {"PASS"}
    counts = {r.table_name: r.row_count for r in load.verify_load(spark, "staging_t").collect()}
    assert counts == {
        "agg_conversion_funnel": 3, "agg_product_performance": 4, "fct_cart_abandonment": 10,
        "fct_purchases": 10, "fct_sessions": 20,
    }
    assert list(counts) == sorted(counts)
    assert spark.table("stg_fct_sessions").columns == S.FCT_SESSIONS.names
    assert spark.table("marts_t.mart_sessions").columns == S.MARTS["mart_sessions"][1]
    # loading again replaces
    load.load(spark, f"{tmp_path}/store/gold", "staging_t")
    assert spark.table("staging_t.fct_sessions").count() == 20


def test_materialise_refuses_other_kinds(spark):
    with pytest.raises(ValueError):
        models.materialise({"x": spark.range(1)}, "index")


def test_gold_presence(spark, finished, tmp_path):
    lake, _ = finished
    got = {r.table_name: (r.row_count, r.status) for r in gate.gold_presence(spark, lake.gold).collect()}
    assert got["fct_sessions"] == (20, "PASS") and len(got) == 5
    spark.read.parquet(f"{lake.gold}/fct_sessions").write.parquet(str(tmp_path / "gold/fct_sessions"))
    got = {r.table_name: (r.row_count, r.status) for r in gate.gold_presence(spark, str(tmp_path / "gold")).collect()}
    assert got["fct_sessions"][1] == "PASS" and got["fct_purchases"] == (None, "FAIL")


def test_publish_empties_and_removes(spark, finished, tmp_path):
    """An emptied table, a table nobody declared, nested JSON, a fresh target, and a stale one."""
    import shutil

    gold, target = tmp_path / "gold", str(tmp_path / "store")
    shutil.copytree(finished[0].gold if isinstance(finished, tuple) else finished.gold, gold)
    publish.publish(spark, str(gold), target)
    before = load.typed(spark, f"{target}/gold", "fct_cart_abandonment").count()
    empty = spark.read.parquet(f"{gold}/fct_cart_abandonment").limit(0)
    shutil.rmtree(gold / "fct_cart_abandonment")
    empty.write.parquet(str(gold / "fct_cart_abandonment"))
    for path in (gold / "fct_cart_abandonment").glob("*.parquet"):
        path.unlink()
    spark.range(3).selectExpr("id", "id % 2 AS day").write.partitionBy("day").parquet(str(gold / "agg_custom"))
    (gold / "agg_custom" / "notes.json").write_text('{"a": 1}')
    for place in (target, str(tmp_path / "fresh")):
        publish.publish(spark, str(gold), place)
        assert before > 0 and load.typed(spark, f"{place}/gold", "fct_cart_abandonment").count() == 0
        assert spark.read.parquet(f"{place}/gold/agg_custom").count() == 3
        assert (spark.read.text(f"{place}/gold/agg_custom/notes.json").first().value) == '{"a": 1}'
    shutil.rmtree(gold / "agg_custom")
    publish.publish(spark, str(gold), target)
    assert "agg_custom" not in {r.table_name for r in publish.inventory(spark, f"{target}/gold").collect()}


def _stamps(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in root.rglob("*.parquet") if "_published" not in str(p)}


def test_publish_writes_only_what_changed(spark, finished, tmp_path):
    import shutil

    gold, store = tmp_path / "gold", tmp_path / "store"
    shutil.copytree(finished[0].gold, gold)
    spark.range(4).selectExpr("id", "map('a', id) AS m").write.parquet(str(gold / "agg_custom"))
    first = publish.publish(spark, str(gold), str(store))
    assert first["partitions_written"] > 5
    before = _stamps(store / "gold")
    assert publish.publish(spark, str(gold), str(store), dry_run=True)["partitions_written"] == 0
    second = publish.publish(spark, str(gold), str(store))
    assert (second["partitions_written"], second["partitions_removed"]) == (0, 0)
    assert _stamps(store / "gold") == before

    # The same rows in other files are no change; one value is, as is a day that is gone.
    sessions = spark.read.parquet(str(gold / "fct_sessions")).repartition(3)
    more = "CASE WHEN session_date = DATE'2019-10-02' THEN event_count + 1 ELSE event_count END AS event_count"
    changed = sessions.selectExpr(*[more if c == "event_count" else c for c in sessions.columns])
    changed.where("session_date < DATE'2019-10-03'").write.partitionBy("session_date").parquet(str(tmp_path / "anew"))
    shutil.rmtree(gold / "fct_sessions")
    shutil.copytree(tmp_path / "anew", gold / "fct_sessions")
    planned = publish.publish(spark, str(gold), str(store), dry_run=True)
    assert (planned["partitions_written"], planned["partitions_removed"]) == (1, 1)
    publish.publish(spark, str(gold), str(store))
    after = _stamps(store / "gold")
    assert {p for p in before if after.get(p) != before[p]} == {
        p for p in before if p.startswith(("fct_sessions/session_date=2019-10-02", "fct_sessions/session_date=2019-10-03"))
    }
    spark.catalog.refreshByPath(str(store))
    ours, theirs = (load.typed(spark, f"{root}", "fct_sessions") for root in (gold, store / "gold"))
    assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()

    # A published file that was lost, and a publication that broke off.
    lost = next((store / "gold/fct_purchases").glob("*/*.parquet"))
    lost.unlink()
    assert publish.publish(spark, str(gold), str(store))["partitions_written"] == 1
    shutil.rmtree(store / "gold/_published")
    assert publish.publish(spark, str(gold), str(store), dry_run=True)["partitions_written"] > 5


def test_digest_of_a_partition_is_of_its_rows(spark):
    from shoptrail.sources import differences

    def digest(rows):
        found = differences.facts(spark.createDataFrame(rows, "a string, b string, day date"), "t", "day").where("part != '*'")
        return {r.part: (r.n_rows, r.digest) for r in found.collect()}

    one = digest([("x", None, None), ("y", "z", None)])
    assert set(one) == {differences.NO_VALUE}
    assert one == digest([("y", "z", None), ("x", None, None)])
    assert one != digest([(None, "x", None), ("y", "z", None)])
    assert one != digest([("x", None, None), ("x", None, None)])
    assert digest([]) == {}
