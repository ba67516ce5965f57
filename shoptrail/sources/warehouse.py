"""Replace a set of warehouse tables together: all of them, or none.

Every table is written beside the one in use, under a name of its own, and checked; then the views that bear the tables'
names are pointed to the new ones. A failure before that leaves everything as it was; one in between is rolled back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_MARK = "__v"


def _plain(spark: SparkSession, name: str) -> str | None:
    """The table a view reads, None where there is no view of that name."""
    if not spark.catalog.tableExists(name):
        return None
    found = spark.catalog.getTable(name)
    if found.tableType != "VIEW":
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    return rows[0]["data_type"].split()[-1] if rows else None


def _point(spark: SparkSession, view: str, table: str) -> None:
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        spark.sql(f"DROP TABLE {view}")  # from before tables were replaced this way
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {table}")


def replace_tables(spark: SparkSession, frames: dict[str, DataFrame], schema: str, checked: bool = True) -> dict[str, DataFrame]:
    """Write all frames as tables of ``schema`` and make them the ones in use; returns the views by name.

    With ``checked`` the rows of each new table are counted against its frame before anything is switched.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    load = uuid.uuid4().hex[:12]
    new = {name: f"`{schema}`.`{name}{_MARK}{load}`" for name in frames}
    try:
        for name, df in frames.items():
            df.write.saveAsTable(new[name].replace("`", ""))
        if checked:
            for name, df in frames.items():
                wrote, meant = spark.table(new[name]).count(), df.count()
                if wrote != meant:
                    raise ValueError(f"{name}: {wrote} rows in the table, {meant} in its source")
        old = {name: _plain(spark, f"`{schema}`.`{name}`") for name in frames}
        switched = []
        try:
            for name in frames:
                _point(spark, f"`{schema}`.`{name}`", new[name])
                switched.append(name)
        except Exception:
            for name in switched:
                view = f"`{schema}`.`{name}`"
                if old[name]:
                    _point(spark, view, old[name])
                else:
                    spark.sql(f"DROP VIEW IF EXISTS {view}")
            raise
    except Exception:
        for table in new.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        raise
    for table in old.values():
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return {name: spark.table(f"`{schema}`.`{name}`") for name in frames}
