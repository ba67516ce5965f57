"""Time the headline queries; print one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8)

Every step runs once to warm up and is then timed. Queries run to a sink that discards rows. The
``stage_*`` entries are the jobs of one full pipeline, from stream ingest to served marts, each
reading and writing its layers.
"""

from __future__ import annotations

import json
import os
import sys
import time

from shoptrail.plans import incremental, medallion, testdata
from shoptrail.plans.medallion import Lake
from shoptrail.session import new_shared_path, start
from shoptrail.sources import publish
from shoptrail.verify import registry

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "bronze_events", "quarantine_reason_counts", "silver_events", "session_events", "fct_sessions",
    "fct_purchases", "agg_product_performance", "session_funnel_flags", "agg_conversion_funnel",
    "cart_event_details", "fct_cart_abandonment", "event_type_histogram", "replay_payload",
    "fixed_size_sample", "sample_event_ids", "mart_sessions", "mart_product_performance",
    "mart_conversion_funnel", "session_kpis", "top_products_by_revenue", "funnel_by_day",
    "gold_row_counts", "dq_bronze", "dq_silver", "dq_fct_sessions", "dq_cross_layer", "dq_pipeline",
    "column_tests",
)


def seconds(action) -> float:
    began = time.perf_counter()
    action()
    return round(time.perf_counter() - began, 3)


def stages(spark, lake: Lake) -> dict[str, float]:
    stream = testdata.topic_records(testdata.stream_events(spark, SF_DIR))
    name = registry._query_name(lake)
    jobs = {
        "ingest": lambda: medallion.ingest(stream, lake, query_name=name),
        "silver": lambda: medallion.build_silver(spark, lake),
        "sessions": lambda: medallion.build_sessions(spark, lake),
        "product_marts": lambda: medallion.build_product_marts(spark, lake),
        "funnel_marts": lambda: medallion.build_funnel_marts(spark, lake),
        "verify": lambda: medallion.verify(spark, lake),
        "publish": lambda: publish.publish(spark, lake.gold, f"{lake.root}/store"),
    }
    return {f"stage_{job}": seconds(action) for job, action in jobs.items()}


def beside(spark, lake: Lake) -> dict[str, float]:
    """Jobs that a full build does not run: the first update of a day, which builds indexes and state, the next one, which
    finds them, compaction, and serving. Not part of the total."""
    days = incremental.days_between(medallion.read_bronze(spark, lake), None, None)
    schema = lake.root.rsplit("-", 1)[-1]
    jobs = {
        "update_first": lambda: incremental.update(spark, lake, days[-1:]),
        "update_next": lambda: incremental.update(spark, lake, days[-2:-1]),
        "compact": lambda: medallion.compact(spark, lake),
        "serve": lambda: medallion.serve(spark, lake, f"{lake.root}/served", f"staging_{schema}", f"marts_{schema}"),
    }
    return {job: seconds(action) for job, action in jobs.items()}


def main() -> None:
    spark = start(
        "bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        registry.REGISTRY[name][0](spark, SF_DIR).write.format("noop").mode("overwrite").save()

    registry.lake(spark, SF_DIR)
    built = Lake(new_shared_path(spark, "bench"))
    spent = stages(spark, built)
    pipeline = sum(spent.values())
    extra = beside(spark, built)
    for name in HEADLINE:
        run(name)
        spent[name] = seconds(lambda: run(name))
        print(f"{name}: {spent[name]}", file=sys.stderr, flush=True)
    delivered = testdata.deliveries(testdata.read_events(spark, SF_DIR)).count()
    print(
        json.dumps(
            {
                "metric": "headline queries and one full pipeline build",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "raw_rows": delivered,
                "pipeline_sec": round(pipeline, 3),
                "pipeline_rows_per_sec": round(delivered / pipeline),
                "cpus": int(CPUS),
                "beside": extra,
            }
        )
    )


if __name__ == "__main__":
    main()
