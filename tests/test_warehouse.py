"""Tables replaced together, the gate job, default sources, selection of first rows."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.__main__ import main
from shoptrail.operators import sampling
from shoptrail.plans import medallion
from shoptrail.plans.medallion import Lake
from shoptrail.sources import csv_events
from shoptrail.sources.warehouse import replace_tables


def tables_of(spark, schema):
    return sorted(t.name for t in spark.catalog.listTables(schema) if t.tableType != "VIEW" and not t.isTemporary)


def test_all_tables_or_none(spark):
    def frames(n):
        return {"a": spark.range(n), "b": spark.range(2 * n)}

    first = replace_tables(spark, frames(3), "together")
    assert {k: v.count() for k, v in first.items()} == {"a": 3, "b": 6}
    replace_tables(spark, frames(5), "together")
    assert spark.table("together.a").count() == 5 and len(tables_of(spark, "together")) == 2
    # The second frame fails while it is written: nothing changes, and nothing is left behind.
    bad = {"a": spark.range(9), "b": spark.range(9).withColumn("id", F.raise_error(F.lit("bad file")).cast("bigint"))}
    before = tables_of(spark, "together")
    with pytest.raises(Exception, match="bad file"):
        replace_tables(spark, bad, "together")
    assert (spark.table("together.a").count(), spark.table("together.b").count()) == (5, 10)
    assert tables_of(spark, "together") == before


def test_a_switch_that_fails_is_rolled_back(spark, monkeypatch):
    from shoptrail.sources import warehouse

    replace_tables(spark, {"a": spark.range(1), "b": spark.range(1)}, "rolled")
    real = warehouse._point

    def point(session, view, table):
        if "b`" in view and "`b__" in table:
            monkeypatch.setattr(warehouse, "_point", real)
            raise RuntimeError("no more")
        real(session, view, table)

    monkeypatch.setattr(warehouse, "_point", point)
    with pytest.raises(RuntimeError):
        replace_tables(spark, {"a": spark.range(4), "b": spark.range(4)}, "rolled")
    assert (spark.table("rolled.a").count(), spark.table("rolled.b").count()) == (1, 1)


def test_tables_from_before_become_views(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS older")
    spark.range(2).write.mode("overwrite").saveAsTable("older.a")
    assert replace_tables(spark, {"a": spark.range(7)}, "older")["a"].count() == 7


def test_gate_on_an_empty_lake(spark, tmp_path, capsys):
    lake = Lake(str(tmp_path))
    found = {(r.section, r.check): r.status for r in medallion.quality_gate(spark, lake).collect()}
    assert found["bronze_structure", "present"] == found["silver_structure", "present"] == found["suites", "layers"] == "FAIL"
    assert all(found["gold_presence", name] == "FAIL" for name in S.GOLD)
    assert main(["quality-gate", "--lake", str(tmp_path), "--skip-suites"], spark) == 1
    assert "FAILED" in capsys.readouterr().out


def test_gate_job_passes_on_a_sound_run(spark, tmp_path, capsys):
    lines = [",".join(S.SOURCE_CSV.names)]
    for i in range(60):
        lines.append(f"2019-10-01 00:00:{i:02d} UTC,{'cart' if i > 53 else ['view', 'cart', 'purchase'][i % 3]},{i % 7},205,cat.a,acme,1.5,{i // 6},s{i // 6}")
    (tmp_path / "source").mkdir()
    (tmp_path / "source" / "2019-Nov.csv").write_text("\n".join(lines) + "\n")

    def job(*args):
        return main([str(a) for a in args], spark)

    lake, sample = tmp_path / "lake", tmp_path / "sample"
    assert job("sample", "--source-folder", tmp_path / "source", "--limit", 60, "--output", sample) == 0
    assert job("replay", "--input", sample, "--files", tmp_path / "topic") == 0
    assert job("run", "--lake", lake, "--files", tmp_path / "topic") == 0
    known = {"bronze_rows": 60, "silver_rows": 60, "fct_sessions": 10, "fct_purchases": 20, "agg_product_performance": 7, "fct_cart_abandonment": 0, "total_revenue": 30.0}
    (tmp_path / "known.json").write_text(json.dumps({name: [value, 10] for name, value in known.items()}))
    options = ["--sample", sample, "--rows", 60, "--min-rows", 60, "--milestones", tmp_path / "known.json"]
    passed = job("quality-gate", "--lake", lake, *options)
    assert passed == 0, [line for line in capsys.readouterr().out.splitlines() if "FAIL" in line]
    assert job("quality-gate", "--lake", lake, *options, "--skip-suites") == 0
    assert job("quality-gate", "--lake", lake, "--min-rows", 61) == 1
    assert job("compact", "--lake", lake) == 0


def test_default_sources_in_order(spark, tmp_path):
    folder = tmp_path / "source"
    folder.mkdir()

    def put(path, price):
        text = ",".join(S.SOURCE_CSV.names) + f"\n2019-10-01 00:00:00 UTC,view,1,2,c,b,{price},3,s\n"
        (gzip.open(path, "wt") if path.suffix == ".gz" else open(path, "w")).write(text)

    def prices():
        return sorted(r.price for r in csv_events.read_default_source(spark, str(folder)).collect())

    with pytest.raises(FileNotFoundError):
        prices()
    put(folder / "other.csv", 1)
    put(folder / "another.csv", 2)
    assert prices() == ["1", "2"]
    for name, price in (("2020-Jan.csv.gz", 3), ("2019-Nov.csv", 4), ("../2019-Oct.csv.gz", 5), ("2019-Oct.csv", 6)):
        put(folder / name, price)
        assert prices() == [str(price)]


@pytest.mark.parametrize("n", [1, 7, 250, 499, 500, 640, 1_000])
def test_first_rows_by_histogram(spark, monkeypatch, n):
    monkeypatch.setattr(sampling, "_RANKED_ROWS", 3)
    monkeypatch.setattr(sampling, "_HISTOGRAM_PARTS", 4)
    numbers = [(i * i * 7919) % 1_000_003 - 500_000 for i in range(480)] + [(1 << 62) + i for i in range(10)] + [-(1 << 62)] * 10
    frame = spark.createDataFrame([(x,) for x in numbers + [None] * 200], "position bigint").repartition(5)
    got = [r.position for r in sampling.first_rows(frame, n, "position").collect()]
    assert got == (sorted(numbers) + [None] * 200)[:n]
