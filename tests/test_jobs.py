"""The command line, from a source CSV to published marts."""

import pytest

from shoptrail import schemas as S
from shoptrail.__main__ import main


@pytest.fixture(scope="module")
def work(tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    lines = [",".join(S.SOURCE_CSV.names)]
    for i in range(120):
        kind = ["view", "view", "cart", "purchase"][i % 4]
        lines.append(f"2019-10-01 00:{i // 60:02d}:{i % 60:02d} UTC,{kind},{i % 7},205,cat.a,acme,{i}.5,{i // 6},s{i // 6}")
    (root / "source.csv").write_text("\n".join(lines) + "\n")
    return root


def test_from_csv_to_marts(spark, work, capsys):
    def job(*args):
        return main([str(a) for a in args], spark)

    sample, lake, files = work / "sample", work / "lake", work / "topic"
    assert job("sample", "--input", work / "source.csv", "--limit", 200, "--output", sample) == 0
    assert "fewer than 200" in capsys.readouterr().err
    assert job("check-sample", "--input", sample, "--rows", 120) == 0
    assert job("check-sample", "--input", sample, "--rows", 121) == 1
    assert job("replay", "--input", sample, "--files", files, "--limit", 100) == 0
    assert spark.read.parquet(str(files)).count() == 100
    assert job("ingest", "--lake", lake, "--files", files) == 0
    for step in ("silver", "sessions", "product-marts", "funnel-marts", "gold"):
        assert job(step, "--lake", lake) == 0
    assert job("verify", "--lake", lake) == 0
    assert job("verify", "--lake", lake, "--gold-only") == 0
    assert job("verify", "--lake", lake, "--min-bronze-rows", 101) == 1
    assert job("publish", "--lake", lake, "--target", work / "store", "--dry-run") == 0
    assert job("serve", "--lake", lake, "--target", work / "store") == 0
    assert spark.table("marts.mart_sessions").count() > 0


def test_run_takes_everything(spark, work):
    files = work / "topic_all"
    assert main(["replay", "--input", str(work / "sample"), "--files", str(files)], spark) == 0
    assert main(["run", "--lake", str(work / "lake_all"), "--files", str(files), "--min-bronze-rows", "120"], spark) == 0


@pytest.mark.parametrize("limit", ["0", "-5"])
def test_limits_must_be_positive(spark, limit):
    with pytest.raises(SystemExit):
        main(["sample", "--input", "x", "--limit", limit, "--output", "y"], spark)


def test_a_topic_is_needed(spark, work):
    with pytest.raises(SystemExit):
        main(["ingest", "--lake", str(work / "lake")], spark)
