"""Product performance kept up to date: mergeable state by day.

Counts and revenue of a product could be corrected by differences, its distinct users could not. So the state holds one row
per (day, product, user), and one per (day, product) for attributes. An update replaces the touched days of the state, and
builds anew only the products that occur on them, before or after.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shoptrail import schemas as S
from shoptrail.operators import products
from shoptrail.session import cut_lineage
from shoptrail.sources.layers import drop_path, path_exists, replace_days, write_layer

Days = list


@dataclass(frozen=True)
class ProductState:
    path: str

    @property
    def users(self) -> str:
        return f"{self.path}/users"

    @property
    def attributes(self) -> str:
        return f"{self.path}/attributes"

    def known(self, spark: SparkSession) -> bool:
        return all(path_exists(spark, f"{path}/_SUCCESS") for path in (self.users, self.attributes))

    def forget(self, spark: SparkSession) -> None:
        drop_path(spark, self.path)

    def build(self, events: DataFrame) -> None:
        write_layer(products.by_day_and_user(events), self.users, "event_date")
        write_layer(products.attributes_by_day(events), self.attributes, "event_date")

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        return (
            spark.read.schema(products.USER_STATE).parquet(self.users),
            spark.read.schema(products.ATTRIBUTE_STATE).parquet(self.attributes),
        )

    def _products_of(self, spark: SparkSession, days: Days) -> DataFrame:
        """Products of some days; their folders alone are read."""
        users, _ = self.read(spark)
        return users.where(F.col("event_date").isin(days)).select("product_id").distinct()

    def update(self, events: DataFrame, days: Days, table: str, at: Column | None = None) -> None:
        """Bring the table of product performance at ``table`` up to date.

        ``events`` has all rows of the given days; other days of it are not read. Without state everything is built.
        """
        spark = events.sparkSession
        if not self.known(spark) or not path_exists(spark, table):
            self.build(events)
            write_layer(products.from_state(*self.read(spark), at), table)
            return
        before = cut_lineage(self._products_of(spark, days))
        part = events.where(F.col("event_date").isin(days))
        replace_days(products.by_day_and_user(part), self.users, "event_date", days)
        replace_days(products.attributes_by_day(part), self.attributes, "event_date", days)
        touched = cut_lineage(before.unionByName(self._products_of(spark, days)).distinct().withColumnRenamed("product_id", "touched"))
        same = F.col("product_id").eqNullSafe(F.col("touched"))
        users, attributes = (state.join(touched, same, "left_semi") for state in self.read(spark))
        kept = spark.read.schema(S.AGG_PRODUCT_PERFORMANCE).parquet(table).join(touched, same, "left_anti")
        # The table is read and replaced: one row per product, set down first.
        write_layer(cut_lineage(kept.unionByName(products.from_state(users, attributes, at))), table)
