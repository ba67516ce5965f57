"""Registered queries: name -> (Spark query, SQL statement or None)."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructType, TimestampType

from shoptrail import schemas as S
from shoptrail.operators import (
    carts, funnel, models, products, purchases, refine, report, sampling, sessionize, sessions, validity,
)
from shoptrail.plans import incremental, medallion, testdata
from shoptrail.quality import gate, suites
from shoptrail.quality.column_tests import ALL_TESTS, column_tests
from shoptrail.session import configure, new_shared_path
from shoptrail.sources import csv_events, load, publish, topic
from shoptrail.sources.layers import read_layer
from shoptrail.verify import oracle

Query = Callable[[SparkSession, str], DataFrame]

_CLOCKS = (
    "ingested_at", "bronze_ingested_at", "silver_processed_at", "sessionized_at", "gold_processed_at",
)


def _comparable(df: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Leave out clocks, round doubles, and give times without a zone.

    Category ids exceed 2^53, so they go out as text lest a data frame library turns them to doubles.
    """

    def shaped(name: str, kind) -> Column:
        if name == "category_id":
            return F.col(name).cast("string").alias(name)
        if isinstance(kind, DoubleType):
            return F.round(name, 6 if name.endswith("_rate") else 2).alias(name)
        if isinstance(kind, TimestampType):
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)

    kept = [f for f in df.schema if f.name not in _CLOCKS and f.name not in drop]
    return df.select(*[shaped(f.name, f.dataType) for f in kept])


def _columns(schema, drop: tuple[str, ...] = ()) -> str:
    """The same columns for SQL."""

    def shaped(f) -> str:
        if f.name == "category_id":
            return "CAST(category_id AS VARCHAR) AS category_id"
        if isinstance(f.dataType, DoubleType):
            return f"round({f.name}, {6 if f.name.endswith('_rate') else 2}) AS {f.name}"
        return f.name

    return ", ".join(shaped(f) for f in schema if f.name not in _CLOCKS and f.name not in drop)


# --- Layers, each derived from the given tables -------------------------------------------------

def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return validity.judge(testdata.topic_records(testdata.read_events(spark, sf_dir)))


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity.accepted(_judged(spark, sf_dir))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity.rejected(_judged(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refine.to_silver(bronze(spark, sf_dir))


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessionize.order_sessions(silver(spark, sf_dir))


def fct_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_facts(silver(spark, sf_dir))


def fct_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases.purchase_facts(session_events(spark, sf_dir))


def agg_product_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.product_performance(silver(spark, sf_dir))


def session_funnel_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.session_flags(session_events(spark, sf_dir))


def agg_conversion_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel.conversion_funnel(session_funnel_flags(spark, sf_dir))


def cart_event_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = silver(spark, sf_dir).withColumnRenamed("user_session", "session_id")
    return carts.cart_details(events)


def fct_cart_abandonment(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fct_sessions(spark, sf_dir)
    return carts.cart_abandonment(facts, cart_event_details(spark, sf_dir))


def _layer(build: Query, source: str, schema, drop: tuple[str, ...] = ()) -> tuple[Query, str]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(build(spark, sf_dir), drop)

    return query, oracle.over(source, f"SELECT {_columns(schema, drop)} FROM {source}")


def _quarantine_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validity.reason_counts(quarantine(spark, sf_dir))


REGISTRY: dict[str, tuple[Query, str | None]] = {
    "bronze_events": _layer(bronze, "bronze", S.BRONZE),
    "quarantine_events": _layer(quarantine, "quarantine", S.QUARANTINE, ("raw_value",)),
    "quarantine_reason_counts": (
        _quarantine_reason_counts,
        oracle.over(
            "quarantine",
            "SELECT invalid_reason, count(*) AS row_count FROM quarantine GROUP BY invalid_reason",
        ),
    ),
    "silver_events": _layer(silver, "silver", S.SILVER),
    "session_events": _layer(session_events, "session_events", S.SESSION_EVENTS),
    "fct_sessions": _layer(fct_sessions, "fct_sessions", S.FCT_SESSIONS),
    "fct_purchases": _layer(fct_purchases, "fct_purchases", S.FCT_PURCHASES),
    "agg_product_performance": _layer(
        agg_product_performance, "agg_product_performance", S.AGG_PRODUCT_PERFORMANCE
    ),
    "session_funnel_flags": (
        lambda spark, sf_dir: session_funnel_flags(spark, sf_dir),
        oracle.over("flags", "SELECT * FROM flags"),
    ),
    "agg_conversion_funnel": _layer(
        agg_conversion_funnel, "agg_conversion_funnel", S.AGG_CONVERSION_FUNNEL
    ),
    "cart_event_details": (
        lambda spark, sf_dir: _comparable(cart_event_details(spark, sf_dir)),
        oracle.over("cart_details", "SELECT * FROM cart_details"),
    ),
    "fct_cart_abandonment": _layer(
        fct_cart_abandonment, "fct_cart_abandonment", S.FCT_CART_ABANDONMENT
    ),
}

# --- Queries over a finished run -----------------------------------------------------------------

_LAKES: dict[tuple[str, str], medallion.Lake] = {}
_PUBLISHED: dict[str, str] = {}
_BUILDING = threading.Lock()


def lake(spark: SparkSession, sf_dir: str) -> medallion.Lake:
    """Layers built from the given tables by the real jobs, stream ingest included.

    Built once per application and folder, in the shared scratch folder; what validates and serves
    then reads finished layers, as it would in production.
    """
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    with _BUILDING:
        if key not in _LAKES:
            built = medallion.Lake(new_shared_path(spark, "lake"))
            records = testdata.topic_records(testdata.stream_events(spark, sf_dir))
            medallion.run(spark, built, records, query_name=_query_name(built))
            _LAKES[key] = built
        return _LAKES[key]


def _query_name(built: medallion.Lake) -> str:
    """Streams of one session need different names."""
    return "topic_to_bronze_" + built.root.rsplit("-", 1)[-1]


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return medallion.read_tables(spark, lake(spark, sf_dir))


def _suite(name: str) -> tuple[Query, str]:
    suite = getattr(suites, name.upper())
    return lambda spark, sf_dir: suites.check(name, suite, _tables(spark, sf_dir)), oracle.suite(name)


def _mart(name: str) -> tuple[Query, str]:
    """Publish, typed load, staging passthrough and mart, held against the layer they come from."""
    source, columns = S.MARTS[name]
    schema = StructType([S.GOLD[source][0][c] for c in columns])

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(models.marts(_staged(spark, sf_dir))[name])

    return query, oracle.over(source, f"SELECT {_columns(schema)} FROM {source}")


def _published(spark: SparkSession, sf_dir: str) -> str:
    source = lake(spark, sf_dir).gold
    with _BUILDING:
        if source not in _PUBLISHED:
            target = new_shared_path(spark, "published")
            publish.publish(spark, source, target)
            _PUBLISHED[source] = f"{target}/{S.CURATED_PREFIX}"
        return _PUBLISHED[source]


def _loaded(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    root = _published(spark, sf_dir)
    return {name: load.typed(spark, root, name) for name in S.GOLD}


def _staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return models.staging(_loaded(spark, sf_dir))


def _staging(name: str) -> tuple[Query, str]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(_staged(spark, sf_dir)[f"stg_{name}"])

    return query, oracle.over(name, f"SELECT {_columns(S.GOLD[name][0])} FROM {name}")


def _lake_marts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = _tables(spark, sf_dir)
    return models.marts(models.staging({name: tables[name] for name in S.GOLD}))


def _column_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    staged = models.staging({name: tables[name] for name in S.GOLD})
    return column_tests({**tables, **staged, **models.marts(staged)})


def _column_tests_sql() -> str:
    """Every declared test as one SELECT over the curated table its relation passes through."""
    base = {name: name for name in S.GOLD}
    base |= {f"stg_{name}": name for name in S.GOLD} | {name: src for name, (src, _) in S.MARTS.items()}
    selects = []
    for relation, columns in ALL_TESTS.items():
        for column, tests in columns.items():
            for test in tests:
                name, table = test if isinstance(test, str) else test[0], base[relation]
                if name == "not_null":
                    found = f"SELECT count(*) FROM {table} WHERE {column} IS NULL"
                elif name == "unique":
                    found = (
                        f"SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
                        f"GROUP BY {column} HAVING count(*) > 1)"
                    )
                else:
                    allowed = ", ".join(str(value) for value in test[1])
                    found = f"SELECT count(DISTINCT {column}) FROM {table} WHERE {column} NOT IN ({allowed})"
                selects.append(
                    f"SELECT '{relation}' AS relation, '{column}' AS column_name, '{name}' AS test, "
                    f"({found}) AS failures"
                )
    union = " UNION ALL ".join(selects)
    return oracle.over(
        " ".join(S.GOLD),
        f"SELECT *, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({union})",
    )


def _milestones_sql() -> str:
    targets = ", ".join(
        f"('{name}', CAST({value} AS DOUBLE), CAST({slack} AS DOUBLE))"
        for name, (value, slack) in S.MILESTONES.items()
    )
    actual = " UNION ALL ".join(
        f"SELECT '{name}' AS metric, CAST(({sql}) AS DOUBLE) AS actual"
        for name, sql in {
            "bronze_rows": "SELECT count(*) FROM bronze",
            "silver_rows": "SELECT count(*) FROM silver",
            "fct_sessions": "SELECT count(*) FROM fct_sessions",
            "fct_purchases": "SELECT count(*) FROM fct_purchases",
            "agg_product_performance": "SELECT count(*) FROM agg_product_performance",
            "fct_cart_abandonment": "SELECT count(*) FROM fct_cart_abandonment",
            "total_revenue": "SELECT sum(purchase_amount) FROM fct_purchases",
        }.items()
    )
    return oracle.over(
        "bronze " + " ".join(S.GOLD),
        f"""SELECT metric, round(actual, 2) AS actual, expected, tolerance,
            round(abs(actual - expected), 2) AS delta,
            CASE WHEN abs(actual - expected) <= tolerance THEN 'ok' ELSE 'DRIFT' END AS status
        FROM ({actual}) JOIN (VALUES {targets}) t(metric, expected, tolerance) USING (metric)""",
    )


def _stream_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    fresh = medallion.Lake(new_shared_path(spark, "stream"))
    records = testdata.topic_records(testdata.stream_events(spark, sf_dir))
    medallion.ingest(records, fresh, query_name=_query_name(fresh))
    return _comparable(medallion.read_bronze(spark, fresh))


_INCREMENTAL: dict[tuple[str, str], medallion.Lake] = {}


def _incremental_lake(spark: SparkSession, sf_dir: str) -> medallion.Lake:
    """Bronze as ingested; silver and gold brought up to date for two ranges of days, one after the other, and once more
    for the last day, which then finds indexes and state. Built once per application and folder."""
    configure(spark)
    key = (spark.sparkContext.applicationId, sf_dir)
    with _BUILDING:
        if key not in _INCREMENTAL:
            built = medallion.Lake(new_shared_path(spark, "incremental"))
            records = testdata.topic_records(testdata.stream_events(spark, sf_dir))
            medallion.ingest(records, built, query_name=_query_name(built))
            days = medallion.pending_days(spark, built)
            for part in (days[: len(days) // 2], days[len(days) // 2 :], days[-1:]):
                incremental.update(spark, built, part)
            _INCREMENTAL[key] = built
        return _INCREMENTAL[key]


def _incremental(place: str, schema) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        built = _incremental_lake(spark, sf_dir)
        return _comparable(read_layer(spark, getattr(built, place) if hasattr(built, place) else built.gold_table(place), schema))

    return query


def _compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topic drained twice from its start, both runs' batches folded into one folder; silver takes each event once."""
    configure(spark)
    fresh = medallion.Lake(new_shared_path(spark, "compacted"))
    for reset in (False, True):
        records = testdata.topic_records(testdata.stream_events(spark, sf_dir))
        medallion.ingest(records, fresh, reset=reset, query_name=_query_name(fresh))
    medallion.compact(spark, fresh)
    return _comparable(refine.to_silver(medallion.read_bronze(spark, fresh)))


def _ingest_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drained, then both sinks emptied and the topic drained from its start again."""
    configure(spark)
    fresh = medallion.Lake(new_shared_path(spark, "reset"))
    for reset in (False, True):
        records = testdata.topic_records(testdata.stream_events(spark, sf_dir))
        medallion.ingest(records, fresh, reset=reset, clear_outputs=reset, query_name=_query_name(fresh))
    return _comparable(medallion.read_bronze(spark, fresh))


def _run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(layer, rows_read, rows_written, rows_dropped) as the jobs report them, over bronze of the finished lake."""
    source = lake(spark, sf_dir)
    fresh = medallion.Lake(new_shared_path(spark, "metrics"))
    refined = medallion.read_bronze(spark, source)
    refined.write.partitionBy("event_date", "event_type").parquet(fresh.bronze)
    found = {"silver": medallion.build_silver(spark, fresh), **medallion.build_gold(spark, fresh)}
    rows = [(name, m.rows_read, m.rows_written, m.rows_dropped) for name, m in found.items()]
    return spark.createDataFrame(rows, "layer string, rows_read bigint, rows_written bigint, rows_dropped bigint")


def _run_metrics_sql() -> str:
    read = {"silver": "bronze", "session_events": "silver", "fct_sessions": "silver"}
    layers = ("silver", "session_events", *S.GOLD)
    return oracle.over(
        "bronze silver session_events " + " ".join(S.GOLD),
        "SELECT *, rows_read - rows_written AS rows_dropped FROM (" + " UNION ALL ".join(
            f"SELECT '{name}' AS layer, (SELECT count(*) FROM {read.get(name, 'session_events')}) AS rows_read, "
            f"(SELECT count(*) FROM {name}) AS rows_written" for name in layers
        ) + ")",
    )


def _load_and_materialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published, loaded as warehouse tables, loaded again over them, marts built: rows of every table in the warehouse."""
    source = lake(spark, sf_dir)
    name = new_shared_path(spark, "store").rsplit("-", 1)[1]
    staging, presented = f"staging_{name}", f"marts_{name}"
    medallion.serve(spark, source, f"{source.root}/store_{name}", staging, presented)
    load.load(spark, f"{source.root}/store_{name}/{S.CURATED_PREFIX}", staging)
    return report.row_counts({
        **{table: spark.table(f"{staging}.{table}") for table in S.GOLD}, **{table: spark.table(f"{presented}.{table}") for table in S.MARTS},
    })


def _quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = testdata.read_events(spark, sf_dir)
    return medallion.quality_gate(spark, lake(spark, sf_dir), testdata.sample_rows(events), _delivered(events))


def _quality_gate_sql() -> str:
    named = {
        "sample": ("dq_sample_file", '"check"', "violations", "status"),
        "bronze_structure": ("dq_bronze_structure", '"check"', "violations", "status"),
        "silver_structure": ("dq_silver_structure", '"check"', "violations", "status"),
        "gold_presence": ("gold_presence", "table_name", "0", "status"),
        "milestones": ("dq_milestones", "metric", "CASE status WHEN 'ok' THEN 0 ELSE 1 END", "CASE status WHEN 'ok' THEN 'PASS' ELSE 'FAIL' END"),
    }
    parts = [
        f"SELECT '{section}' AS section, {check} AS \"check\", CAST({violations} AS BIGINT) AS violations, {status} AS status FROM ({REGISTRY[query][1]})"
        for section, (query, check, violations, status) in named.items()
    ]
    parts.append(f"SELECT 'suite_' || suite AS section, \"check\", violations, status FROM ({oracle.all_suites()})")
    return " UNION ALL ".join(parts)


def _faulty(name: str) -> tuple[Query, str]:
    """A suite over its table with planted faults, so that what it counts is not nothing."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = _tables(spark, sf_dir)
        clocks = [c for c in _CLOCKS if c in tables[name].columns]
        tables[name].drop(*clocks).createOrReplaceTempView(f"planted_{name}")
        numbered = f"(SELECT *, CAST(substr(event_id, 8) AS BIGINT) AS n FROM planted_{name}) numbered"
        planted = spark.sql(oracle.FAULTY[name].format(numbered=numbered, table=f"planted_{name}"))
        for clock in clocks:
            planted = planted.withColumn(clock, F.current_timestamp())
        return suites.check(name, getattr(suites, name.upper()), {**tables, name: planted})

    return query, oracle.faulty(name)


def _delivered(events: DataFrame) -> int:
    """Rows that the mapping makes of the given table: every tenth is delivered twice."""
    return events.agg(F.count("*") + F.count_if(F.col("event_id") % 10 == 0)).first()[0]


def _replay_to_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows encoded, written to a topic folder, drained from it twice."""
    configure(spark)
    rows = testdata.sample_rows(testdata.read_events(spark, sf_dir))
    fresh = medallion.Lake(new_shared_path(spark, "replay"))
    records = topic.encode(rows, F.col("source_row"))
    topic.write_files(records, f"{fresh.root}/topic", testdata.TOPIC, testdata.PARTITIONS)
    for _ in range(2):
        stream = topic.read_files(spark, f"{fresh.root}/topic")
        medallion.ingest(stream, fresh, query_name=_query_name(fresh))
    bronze_rows = medallion.read_bronze(spark, fresh)
    return _comparable(bronze_rows.select(*S.PAYLOAD.names, "event_date"))


_SAMPLE_ROWS, _SAMPLE_SEED = 1_000, 42
_TEXT = {c: f"CAST({c} AS VARCHAR) AS {c}" for c in S.PAYLOAD.names}


def _sample_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return testdata.sample_rows(testdata.read_events(spark, sf_dir)).select(*S.SOURCE_CSV.names)


def _sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.fixed_size_sample(_sample_source(spark, sf_dir), _SAMPLE_ROWS, _SAMPLE_SEED).rows


def _sample_sql(select: str) -> str:
    names = S.SOURCE_CSV.names
    texts = ", ".join(_TEXT[c] for c in names)
    row_text = " || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in names)
    return oracle.over(
        "raw",
        f"""SELECT {select} FROM (
          SELECT *, md5(md5('{_SAMPLE_SEED}|' || {row_text}) || '|' ||
              row_number() OVER (PARTITION BY {', '.join(names)})) AS sample_key
          FROM (SELECT {texts} FROM raw))
        ORDER BY sample_key LIMIT {_SAMPLE_ROWS}""",
    )


def _csv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text rows written as CSV and read back by the source scan."""
    path = new_shared_path(spark, "csv")
    source = _sample_source(spark, sf_dir)
    csv_events.write_csv_events(source, path, gzip=True)
    return csv_events.read_csv_events(spark, path, folder=True)


def _payload_sql() -> str:
    def text(name: str) -> str:
        return f"coalesce(to_json(nullif({name}, '')), 'null')"

    numbers = {"product_id": "coalesce(CAST(product_id AS VARCHAR), 'null')",
               "user_id": "coalesce(CAST(user_id AS VARCHAR), 'null')",
               "price": "coalesce(CAST(price AS VARCHAR), 'null')",
               "category_id": "coalesce(CAST(TRY_CAST(category_id AS BIGINT) AS VARCHAR), to_json(category_id))"}
    fields = " || ',' || ".join(f"'\"{c}\":' || {numbers.get(c, text(c))}" for c in S.PAYLOAD.names)
    return oracle.over(
        "raw",
        f"""SELECT coalesce(nullif(event_id, ''), 'row_' || source_row) AS key,
            '{{' || {fields} || '}}' AS value FROM raw""",
    )


def _replay_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    rows = testdata.sample_rows(testdata.read_events(spark, sf_dir))
    return topic.encode(rows, F.col("source_row"))


def _first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    rows = testdata.sample_rows(testdata.read_events(spark, sf_dir))
    return sampling.first_rows(rows, 500, "source_row")


def _dq_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    events = testdata.read_events(spark, sf_dir)
    return suites.sample_file(testdata.sample_rows(events), _delivered(events))


_SAMPLE_CHECKS = {
    "expected_rows": "SELECT abs((SELECT count(*) FROM raw) - (SELECT count(*) + count(*) FILTER (event_id % 10 = 0) FROM events))",
    "duplicate_event_id": "SELECT count(*) - count(DISTINCT coalesce(event_id, '')) FROM raw",
    "invalid_event_type": oracle.rows_where("raw", oracle._BAD_TYPE),
    "unparseable_event_time": oracle.rows_where(
        "raw", "try_strptime(replace(event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S') IS NULL"
    ),
    "negative_price": oracle.rows_where("raw", "price < 0"),
}


def _comparable_quarantine_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = lake(spark, sf_dir)
    return _comparable(medallion.read_quarantine(spark, built), ("raw_value",))


REGISTRY |= {
    "event_type_histogram": (
        lambda spark, sf_dir: report.event_type_histogram(bronze(spark, sf_dir)),
        oracle.over(
            "bronze",
            "SELECT coalesce(event_type, 'NULL') AS event_type, count(*) AS row_count FROM bronze GROUP BY 1",
        ),
    ),
    "layer_totals": (
        lambda spark, sf_dir: _comparable(report.totals(bronze(spark, sf_dir), "price", "event_id")),
        oracle.over(
            "bronze",
            "SELECT count(*) AS row_count, round(sum(price), 2) AS total, "
            "count(DISTINCT event_id) AS distinct_keys FROM bronze",
        ),
    ),
    "stream_to_bronze": (_stream_to_bronze, REGISTRY["bronze_events"][1]),
    "incremental_gold": (_incremental("agg_conversion_funnel", S.AGG_CONVERSION_FUNNEL), REGISTRY["agg_conversion_funnel"][1]),
    "incremental_session_events": (_incremental("session_events", S.SESSION_EVENTS), REGISTRY["session_events"][1]),
    "incremental_products": (
        _incremental("agg_product_performance", S.AGG_PRODUCT_PERFORMANCE), REGISTRY["agg_product_performance"][1]
    ),
    "compacted_silver": (_compacted_silver, REGISTRY["silver_events"][1]),
    "ingest_reset": (_ingest_reset, REGISTRY["bronze_events"][1]),
    "run_metrics": (_run_metrics, _run_metrics_sql()),
    "load_and_materialise": (
        _load_and_materialise,
        oracle.over(
            " ".join(S.GOLD),
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
                for name, source in [*((n, n) for n in S.GOLD), *((n, src) for n, (src, _) in S.MARTS.items())]
            ),
        ),
    ),
    "stream_to_quarantine": (_comparable_quarantine_flow, REGISTRY["quarantine_events"][1]),
    "replay_to_bronze": (
        _replay_to_bronze,
        oracle.over(
            "bronze",
            "SELECT event_id, event_time, event_type, product_id, category_id, category_code, "
            "nullif(brand, '') AS brand, round(price, 2) AS price, user_id, user_session, event_date "
            "FROM bronze WHERE event_id <> ''",
        ),
    ),
    "replay_payload": (_replay_payload, _payload_sql()),
    "replay_limit": (
        _first_rows,
        oracle.over(
            "raw",
            f"SELECT source_row, {', '.join(_TEXT.values())} FROM raw ORDER BY source_row LIMIT 500",
        ),
    ),
    "csv_source_events": (
        _csv_events,
        oracle.over(
            "raw",
            "SELECT " + ", ".join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in S.SOURCE_CSV.names)
            + " FROM raw",
        ),
    ),
    "fixed_size_sample": (_sampled, _sample_sql("*, row_number() OVER (ORDER BY sample_key) AS sample_number")),
    "sample_event_ids": (
        lambda spark, sf_dir: sampling.stamp_event_ids(_sampled(spark, sf_dir), _SAMPLE_SEED),
        _sample_sql(
            f"'evt_{_SAMPLE_SEED}_' || lpad(CAST(row_number() OVER (ORDER BY sample_key) AS VARCHAR), 10, '0') "
            "AS event_id, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in S.SOURCE_CSV.names)
        ),
    ),
    **{f"stg_{name}": _staging(name) for name in S.GOLD},
    **{name: _mart(name) for name in S.MARTS},
    "session_kpis": (
        lambda spark, sf_dir: _comparable(
            report.session_kpis(_lake_marts(spark, sf_dir)["mart_sessions"])
        ),
        oracle.over(
            "fct_sessions",
            "SELECT count(*) AS session_count, count(*) FILTER (converted) AS converted_sessions, "
            "round(sum(session_revenue), 2) AS total_revenue, "
            "round(avg(session_duration_seconds), 2) AS avg_duration_sec, "
            "round(count(*) FILTER (converted) / count(*), 6) AS conversion_rate FROM fct_sessions",
        ),
    ),
    "top_products_by_revenue": (
        lambda spark, sf_dir: _comparable(
            report.top_products(_lake_marts(spark, sf_dir)["mart_product_performance"])
        ),
        oracle.over(
            "agg_product_performance",
            "SELECT product_id, category_code, brand, purchase_count, unique_purchasers, "
            "round(total_revenue, 2) AS total_revenue, round(view_to_purchase_rate, 6) AS "
            "view_to_purchase_rate, round(cart_to_purchase_rate, 6) AS cart_to_purchase_rate "
            "FROM agg_product_performance ORDER BY agg_product_performance.total_revenue DESC NULLS LAST, "
            "product_id LIMIT 25",
        ),
    ),
    "funnel_by_day": (
        lambda spark, sf_dir: _comparable(
            report.funnel_by_day(_lake_marts(spark, sf_dir)["mart_conversion_funnel"])
        ),
        oracle.over(
            "agg_conversion_funnel",
            "SELECT session_date, total_sessions, sessions_with_view, sessions_with_cart, "
            "sessions_with_purchase, round(view_to_cart_rate, 6) AS view_to_cart_rate, "
            "round(cart_to_purchase_rate, 6) AS cart_to_purchase_rate, round(view_to_purchase_rate, 6) "
            "AS view_to_purchase_rate, round(cart_abandonment_rate, 6) AS cart_abandonment_rate, "
            "abandoned_cart_sessions FROM agg_conversion_funnel ORDER BY session_date",
        ),
    ),
    "gold_row_counts": (
        lambda spark, sf_dir: report.row_counts(_loaded(spark, sf_dir)),
        oracle.over(
            " ".join(S.GOLD),
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in S.GOLD
            ),
        ),
    ),
    "gold_presence": (
        lambda spark, sf_dir: gate.gold_presence(spark, lake(spark, sf_dir).gold),
        oracle.over(
            " ".join(S.GOLD),
            " UNION ALL ".join(
                f"SELECT '{name}' AS table_name, count(*) AS row_count, 'PASS' AS status FROM {name}"
                for name in S.GOLD
            ),
        ),
    ),
    # Numbers of files depend on how the work was split; the rows in the files that are listed do not.
    "gold_inventory": (
        lambda spark, sf_dir: publish.inventory_rows(spark, lake(spark, sf_dir).gold),
        oracle.over(
            " ".join(S.GOLD),
            " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in S.GOLD)
            + " UNION ALL SELECT 'dq_pipeline_summary.json', 0",
        ),
    ),
    **{f"dq_{name}": _suite(name) for name in oracle.SUITES},
    "dq_pipeline": (
        lambda spark, sf_dir: gate.validate(_tables(spark, sf_dir)),
        oracle.all_suites(),
    ),
    "dq_summary": (
        lambda spark, sf_dir: gate.summarise(gate.validate(_tables(spark, sf_dir)))
        .select("overall_status", F.explode("checks").alias("entry"))
        .select("overall_status", "entry.name", "entry.status", F.concat_ws("; ", "entry.details").alias("details")),
        f"""SELECT max(CASE WHEN failed > 0 THEN 'FAIL' ELSE '' END) OVER () || CASE WHEN
              sum(failed) OVER () = 0 THEN 'PASS' ELSE '' END AS overall_status, name,
            CASE WHEN failed > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
            CASE WHEN failed > 0 THEN found ELSE 'ok' END AS details
        FROM (SELECT suite AS name, count(*) FILTER (status = 'FAIL') AS failed,
              string_agg("check" || ': ' || violations, '; ' ORDER BY "check")
                FILTER (status = 'FAIL') AS found
            FROM ({oracle.all_suites()}) GROUP BY suite)""",
    ),
    "dq_sample_file": (
        _dq_sample, oracle.over("raw", oracle.check_select("sample", _SAMPLE_CHECKS))
    ),
    "dq_bronze_structure": (
        lambda spark, sf_dir: gate.bronze_structure(
            _tables(spark, sf_dir)["bronze"],
            quarantine=medallion.read_quarantine(spark, lake(spark, sf_dir)),
        ),
        oracle.over(
            "bronze quarantine",
            oracle.check_select(
                "bronze_structure",
                {
                    "min_rows": oracle.short_of(1_000_000, "bronze"),
                    "topic_columns": "SELECT 0",
                    "partition_columns": "SELECT 0",
                    "quarantined_rows": oracle.count("quarantine"),
                },
                ("quarantined_rows",),
            ),
        ),
    ),
    "dq_silver_structure": (
        lambda spark, sf_dir: gate.silver_structure(
            _tables(spark, sf_dir)["silver"], _tables(spark, sf_dir)["bronze"]
        ),
        oracle.over(
            "silver",
            oracle.check_select(
                "silver_structure",
                {
                    "min_rows": oracle.short_of(1_000_000, "silver"),
                    "rows_within_bronze": oracle.excess(oracle.count("silver"), oracle.count("bronze")),
                    "duplicate_event_id": oracle.repeats("silver", "event_id"),
                    "cleaned_columns": "SELECT 0",
                },
            ),
        ),
    ),
    "dq_milestones": (
        lambda spark, sf_dir: _comparable(gate.milestones(_tables(spark, sf_dir))),
        _milestones_sql(),
    ),
    "column_tests": (_column_tests, _column_tests_sql()),
}

REGISTRY |= {
    **{f"dq_faulty_{name}": _faulty(name) for name in oracle.FAULTY},
    "quality_gate": (_quality_gate, _quality_gate_sql()),
}
