"""C3, E5 and M16 from co-partitioned user tables: joins without an exchange.

What these measures need of events and orders is one row per user and day.
Both are kept as tables bucketed by the user with the same number of buckets,
so distinct users, order totals and the join between them are computed bucket
by bucket; only the final counts are exchanged.  A user has a row per day at
most, so a user with a third of all events does not make a bucket large.
An order id has one date and one user.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.functions import vocab as V
from queryscope.functions.exprs import date_minus_days
from queryscope.operators import engagement, measures, metrics

USER = "user_pseudo_id"


def user_days(events: DataFrame) -> DataFrame:
    """(user, day): any search event, any submit."""
    search = F.col("event_category") == V.SEARCH_CATEGORY
    return events.filter(F.col(USER).isNotNull()).groupBy(USER, "event_date").agg(
        F.coalesce(F.max(search), F.lit(False)).alias("searched"),
        F.coalesce(F.max(search & (F.col("event_name") == V.SUBMIT)), F.lit(False)).alias("submitted"))


def order_days(orders: DataFrame) -> DataFrame:
    """(user, day): orders and their value."""
    return orders.filter(F.col(USER).isNotNull()).groupBy(USER, "order_date").agg(
        F.count_distinct("order_id").alias("order_count"), F.sum("order_value").alias("order_value"))


def save_by_user(df: DataFrame, name: str, path: str, buckets: int) -> DataFrame:
    """``df`` as a table bucketed and sorted by the user; choose buckets so that one fits a task."""
    df.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, USER).sortBy(USER).saveAsTable(name)
    return df.sparkSession.table(name)


def conversion_funnel(users: DataFrame, bought: DataFrame, as_of: _dt.date, days: int = V.METRIC_WINDOW_DAYS) -> DataFrame:
    """C3 from the two tables."""
    since = date_minus_days(as_of, days)
    searchers = users.filter(F.col("submitted") & (F.col("event_date") >= since)).select(USER).distinct()
    buyers = bought.filter(F.col("order_date") >= since).groupBy(F.col(USER).alias("buyer")).agg(
        F.sum("order_count").alias("order_count"), F.sum("order_value").alias("total_revenue"))
    return metrics.funnel_row(searchers.join(buyers, F.col(USER) == F.col("buyer"), "left"))


def search_to_conversion(users: DataFrame, bought: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """E5 from the two tables."""
    return engagement.search_to_conversion(users.filter(F.col("searched") & F.col("event_date").between(F.lit(start), F.lit(end))),
                                           bought.filter(F.col("order_date").between(F.lit(start), F.lit(end))))


def search_conversion_rate(users: DataFrame, bought: DataFrame) -> DataFrame:
    """M16 from the two tables."""
    events = users.withColumn("event_category", F.when(F.col("searched"), V.SEARCH_CATEGORY))
    return measures.search_conversion_rate(events, bought)
