"""Staging passthroughs and presentation marts, and materialising them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoptrail import schemas as S
from shoptrail.sources.warehouse import replace_tables


def staging(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Curated tables by their contract: exactly the declared columns, in order."""
    return {f"stg_{name}": gold[name].select(*schema.names) for name, (schema, _) in S.GOLD.items()}


def marts(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        name: staged[f"stg_{source}"].select(*columns) for name, (source, columns) in S.MARTS.items()
    }


def materialise(models: dict[str, DataFrame], kind: str, schema: str | None = None) -> list[str]:
    """Publish models as temporary views or as tables; a schema name is used just as given, and its tables are replaced
    together."""
    if kind == "view":
        for name, df in models.items():
            df.createOrReplaceTempView(name)
        return list(models)
    if kind != "table":
        raise ValueError("kind must be 'view' or 'table'")
    if schema:
        spark = next(iter(models.values())).sparkSession
        replace_tables(spark, models, schema, checked=False)
        return [f"{schema}.{name}" for name in models]
    for name, df in models.items():
        df.write.mode("overwrite").saveAsTable(name)
    return list(models)
