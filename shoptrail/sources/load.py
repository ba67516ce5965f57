"""Typed load of published tables into warehouse tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from shoptrail import schemas as S
from shoptrail.operators.report import row_counts
from shoptrail.sources.warehouse import replace_tables


def typed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One published table with its declared types.

    Only leaf Parquet files are read; the partition date is taken from each file's path. Casts are
    explicit and strict: a value that does not fit fails the load instead of turning NULL.
    """
    schema, partition = S.GOLD[name]
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    try:
        leaves = files.parquet(f"{root.rstrip('/')}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return spark.createDataFrame([], schema)  # published empty
    dated = F.regexp_extract("_metadata.file_path", rf"{partition}=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})", 1)

    def column(field):
        value = F.to_date(dated) if field.name == partition else F.col(field.name)
        return value.cast(field.dataType).alias(field.name)

    return leaves.select(*[column(field) for field in schema])


def load(spark: SparkSession, root: str, schema: str = "staging") -> dict[str, DataFrame]:
    """Replace all warehouse tables with what is published under ``root``: all of them, or none if one does not load."""
    return replace_tables(spark, {name: typed(spark, root, name) for name in S.GOLD}, schema)


def verify_load(spark: SparkSession, schema: str = "staging") -> DataFrame:
    return row_counts({name: spark.table(f"{schema}.{name}") for name in S.GOLD})
