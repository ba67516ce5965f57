import gzip
import json

import pytest
from pyspark.sql import functions as F

from shoptrail import schemas as S
from shoptrail.operators import validity
from shoptrail.plans.medallion import Lake, ingest, read_bronze
from shoptrail.sources import csv_events, topic
from shoptrail.sources.layers import Counted, read_dataset, read_layer, require_rows, write_layer

HEADER = ",".join(S.SOURCE_CSV.names)
LINE = '2019-10-01 00:00:00 UTC,view,1,205,"a, ""b""",acme,1.50,7,s1'


def test_csv_plain_gzip_and_folder(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"{HEADER}\n{LINE}\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as handle:
        handle.write(f"{HEADER}\n{LINE}\n{LINE}\n")
    (tmp_path / "notes.txt").write_text("not events")
    assert csv_events.read_csv_events(spark, str(tmp_path / "a.csv")).first().category_code == 'a, "b"'
    assert csv_events.read_csv_events(spark, str(tmp_path / "b.csv.gz")).count() == 2
    assert csv_events.read_csv_events(spark, str(tmp_path), folder=True).count() == 3


def test_csv_columns_go_by_name_and_must_be_there(spark, tmp_path):
    names = S.SOURCE_CSV.names[::-1]
    (tmp_path / "turned.csv").write_text(",".join(names) + ",more\n" + ",".join(names) + ",x\n")
    row = csv_events.read_csv_events(spark, str(tmp_path / "turned.csv")).first()
    assert row.asDict() == {n: n for n in names}
    (tmp_path / "short.csv").write_text("event_time,event_type\na,b\n")
    with pytest.raises(ValueError, match="product_id"):
        csv_events.read_csv_events(spark, str(tmp_path / "short.csv"))


def test_first_available_candidate(spark, tmp_path):
    (tmp_path / "b.csv").write_text(f"{HEADER}\n{LINE}\n")
    paths = [str(tmp_path / n) for n in ("a.csv", "b.csv")]
    assert csv_events.read_first_available(spark, paths).count() == 1
    with pytest.raises(FileNotFoundError):
        csv_events.read_first_available(spark, paths[:1])


def sample(spark, **changes):
    row = {
        "event_id": "e1", "event_time": "2019-10-01 00:00:00 UTC", "event_type": "view", "product_id": "12",
        "category_id": "2053013555631882655", "category_code": "", "brand": None, "price": "1.50",
        "user_id": "7", "user_session": "s1", **changes,
    }
    return spark.createDataFrame([tuple(row[n] for n in S.SAMPLE_CSV.names)], S.SAMPLE_CSV)


def encoded(spark, **changes):
    row = topic.encode(sample(spark, **changes), F.lit(3)).first()
    return row.key, json.loads(row.value)


def test_encoding(spark):
    key, value = encoded(spark)
    assert key == "e1"
    assert value == {
        "event_id": "e1", "event_time": "2019-10-01 00:00:00 UTC", "event_type": "view", "product_id": 12,
        "category_id": 2053013555631882655, "category_code": None, "brand": None, "price": 1.5, "user_id": 7,
        "user_session": "s1",
    }


@pytest.mark.parametrize(
    "column, text, value",
    [
        ("product_id", "abc", "abc"), ("product_id", "12.5", "12.5"), ("product_id", " 12 ", 12),
        ("product_id", "-3", -3), ("price", "1e3", 1000.0), ("price", "7", 7.0), ("price", "1d", "1d"),
        ("price", "n/a", "n/a"), ("price", "", None), ("brand", 'q"uo\\te', 'q"uo\\te'), ("brand", "é", "é"),
        ("user_session", "007", "007"),
    ],
)
def test_encoding_keeps_text_that_is_no_number(spark, column, text, value):
    assert encoded(spark, **{column: text})[1][column] == value


def test_missing_id_is_keyed_by_position(spark):
    assert encoded(spark, event_id="")[0] == "row_3"
    assert encoded(spark, event_id=None)[0] == "row_3"


def test_topic_folder_round_trip(spark, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    topic.write_files(topic.encode(sample(spark), F.lit(1)), f"{lake.root}/topic", "t", 4)
    assert ingest(topic.read_files(spark, f"{lake.root}/topic"), lake) == {"accepted": 1, "rejected": 0}
    row = read_bronze(spark, lake).first()
    assert (row.event_id, row.product_id, row.price, row.kafka_topic) == ("e1", 12, 1.5, "t")
    assert 0 <= row.kafka_partition < 4


def test_layers(spark, tmp_path):
    path = str(tmp_path / "layer")
    schema = S._schema("n bigint, day date")
    days = spark.range(10).select(F.col("id").alias("n"), F.expr("date'2020-01-01' + int(id % 3)").alias("day"))
    seen = Counted("days")
    write_layer(seen.watch(days), path, "day")
    assert seen.rows == 10
    assert read_layer(spark, path, schema).count() == 10
    assert read_layer(spark, path, schema, since="2020-01-02", until="2020-01-02", date_column="day").count() == 3
    one = days.where("day = date'2020-01-01'").limit(1)
    write_layer(one, path, "day", only_touched_partitions=True)
    assert read_layer(spark, path, schema).count() == 7
    write_layer(one, path, "day", mode="append")
    assert read_layer(spark, path, schema).count() == 8
    write_layer(one, path, "day")
    assert read_layer(spark, path, schema).count() == 1


def test_counting_an_empty_result(spark, tmp_path):
    """Adaptive execution removes the whole plan, counter included, once a shuffle comes out empty."""
    none = spark.range(100).where("id + rand() < -1").groupBy("id").agg(F.count("*").alias("n"))
    joined = spark.range(50).join(none, "id")
    seen = Counted("nothing")
    write_layer(seen.watch(joined), str(tmp_path / "none"), "id")
    assert seen.rows == 0


def test_date_range_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "layer")
    days = spark.range(10).select(F.col("id").alias("n"), F.expr("date'2020-01-01' + int(id)").alias("day"))
    write_layer(days, path, "day")
    pruned = read_layer(spark, path, S._schema("n bigint, day date"), since="2020-01-09", date_column="day")
    assert len(pruned.inputFiles()) == 10
    assert pruned.rdd.getNumPartitions() <= 2


def test_guards(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows in silver"):
        require_rows(spark.range(0), "silver")
    assert require_rows(spark.range(3), "x") == 3
    with pytest.raises(FileNotFoundError):
        read_dataset(spark, str(tmp_path / "nowhere"))
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        read_dataset(spark, str(tmp_path / "empty"))


def test_document_is_parsed_once_per_record(spark):
    from builders import event, records

    plan = validity.accepted(validity.judge(records(spark, [event(1)])))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
