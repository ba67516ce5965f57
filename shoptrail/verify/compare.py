"""Run registered queries next to their SQL in DuckDB and report differences.

    python -m shoptrail.verify.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime
import glob
import os
import sys
import time

import duckdb
import pyarrow as pa

from shoptrail.session import start
from shoptrail.verify.registry import REGISTRY


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def canonical(table: pa.Table) -> list[tuple]:
    """Rows as text, columns by name, rows sorted."""

    def text(value) -> str:
        if isinstance(value, datetime.datetime):
            return value.replace(tzinfo=None).isoformat()
        if isinstance(value, float):
            return repr(value)
        return str(value)

    columns = [table.column(name).to_pylist() for name in sorted(table.column_names)]
    return sorted(tuple(text(v) for v in row) for row in zip(*columns))


def difference(ours: pa.Table, theirs: pa.Table) -> str | None:
    if sorted(ours.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(ours.column_names)} vs {sorted(theirs.column_names)}"
    for name in ours.column_names:
        kinds = [str(t.schema.field(name).type).removeprefix("large_") for t in (ours, theirs)]
        if kinds[0] != kinds[1]:
            return f"type of {name}: {kinds[0]} vs {kinds[1]}"
    ours, theirs = canonical(ours), canonical(theirs)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} vs {b}"
    return None


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark = start("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    db, bad = connect(sf_dir), 0
    for name, (query, sql) in REGISTRY.items():
        if names and name not in names:
            continue
        began = time.time()
        frame = query(spark, sf_dir)
        ours = frame.toArrow()
        spent = time.time() - began
        if sql is None:
            print(f"{name:32s} {ours.num_rows:7d} rows  {spent:6.2f}s  no SQL")
            continue
        wrong = difference(ours, db.sql(sql).to_arrow_table())
        bad += wrong is not None
        print(f"{name:32s} {ours.num_rows:7d} rows  {spent:6.2f}s  {'ok' if wrong is None else 'DIFFERS ' + wrong[:600]}", flush=True)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(*sys.argv[1:]))
