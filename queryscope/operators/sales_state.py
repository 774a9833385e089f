"""I1–I4 and D4 from mergeable state: a night aggregates its own day, reports merge the days.

A group's mean, cleaned total and NULL share follow from rows, NULLs and the
exact DECIMAL total (``impute.sales_groups``), and these three add up over
days.  The state is one row per (region, product, day), a folder per month.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryscope.functions.exprs import money_avg
from queryscope.operators.impute import KEYS
from queryscope.operators.typos import materialize, remove
from queryscope.session import path_exists

FILES = 4  # of a month

STATE = "region string, product_id long, order_date date, rows long, null_sales_count long, total decimal(38,2), order_month date"


def store_days(sales: DataFrame, path: str) -> None:
    """Write the state of the days in ``sales`` (whole days), replacing what was there of these days.

    Other days of their months are carried over from the state, not from the
    sales; other months are not touched.
    """
    spark = sales.sparkSession
    state = materialize(sales.groupBy(*KEYS, "order_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("sales_value").isNull()).alias("null_sales_count"),
        F.sum("sales_value").cast("decimal(38,2)").alias("total")).withColumn("order_month", F.trunc("order_date", "month")), "sales-days")
    rows, spent = state, [state]
    if path_exists(spark, path):
        months = [r.order_month for r in state.select("order_month").distinct().collect()]  # months, not rows
        old = spark.read.schema(STATE).parquet(path).filter(F.col("order_month").isin(months))
        rows = materialize(state.unionByName(old.join(state.select("order_date").distinct(), "order_date", "left_anti")), "sales-months")
        spent.append(rows)
    (rows.repartition("order_month", F.pmod(F.xxhash64("product_id"), F.lit(FILES))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("order_month").parquet(path))
    remove(*spent)


def merged_groups(spark: SparkSession, path: str, start: _dt.date | None = None, end: _dt.date | None = None) -> DataFrame:
    """``impute.sales_groups`` of the stored days (from ``start`` to ``end``; only their months' folders are read)."""
    days = spark.read.schema(STATE).parquet(path)
    if start is not None:
        days = days.filter((F.col("order_date") >= F.lit(start)) & (F.col("order_month") >= F.lit(start.replace(day=1))))
    if end is not None:
        days = days.filter((F.col("order_date") <= F.lit(end)) & (F.col("order_month") <= F.lit(end)))
    return days.groupBy(*KEYS).agg(F.sum("rows").alias("rows"), F.sum("null_sales_count").alias("null_sales_count"),
                                   F.sum("total").alias("total"))


def product_avg(groups: DataFrame) -> DataFrame:
    """I1 from the groups: mean of the known sales, their number, and 0 NULLs (as in ``impute.regional_product_avg``)."""
    known = F.col("rows") - F.col("null_sales_count")
    return groups.filter(known > 0).select(*KEYS, money_avg("total", known).alias("avg_sales"), known.alias("sample_size"),
                                           F.lit(0).cast("long").alias("null_count"))
