"""Money totals of the quality suites are exact, whatever the order of rows."""

from pyspark.sql import functions as F

from shoptrail.quality.suites import _total


def test_totals_do_not_depend_on_the_order_of_rows(spark):
    amounts = spark.range(1_000_000).select((F.col("id") % 1_000_003 * 19 + F.lit(1_000_000.37)).alias("amount"))
    one = amounts.coalesce(1).agg(F.expr(_total("amount")).alias("total")).first().total
    many = amounts.repartition(64).agg(F.expr(_total("amount")).alias("total")).first().total
    cents = 100_000_037 * 1_000_000 + 1_900 * (999_999 * 1_000_000 // 2)
    assert one == many and int(one * 100) == cents
    off = amounts.unionAll(spark.sql("SELECT 0.02D AS amount")).agg(F.expr(_total("amount")).alias("total")).first().total
    assert int(off * 100) == cents + 2


def test_missing_and_odd_amounts(spark):
    rows = spark.sql("SELECT * FROM VALUES (1.5D), (CAST(NULL AS DOUBLE)), (2.25D) AS t(amount)")
    assert float(rows.agg(F.expr(_total("amount")).alias("total")).first().total) == 3.75
    assert float(rows.where("false").agg(F.expr(_total("amount")).alias("total")).first().total) == 0
