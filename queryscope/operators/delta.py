"""B6/B7 maintenance: late, corrected and cancelled orders change only what they reach.

An order reaches the search groups of its user on the days up to
``window_days`` before it.  From the changed orders (old and new state) come
the (user, day) pairs they reach; only these pairs are attributed anew, and
only the days they lie on are rewritten in the attribution table and the mart.
Both tables are partitioned by ``event_date``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryscope.functions import vocab as V
from queryscope.operators import etl
from queryscope.operators.typos import materialize, remove
from queryscope.plans.joins import range_semi_join

PAIR = ["user_pseudo_id", "event_date"]


def build_tables(fact: DataFrame, orders: DataFrame, attribution_path: str, metrics_path: str) -> None:
    """The full attribution table and mart, partitioned by day."""
    rows = etl.search_order_attribution(fact, orders)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(attribution_path)
    mart = etl.search_metrics_from_orders(fact, orders)
    mart.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_date").parquet(metrics_path)


def reached_pairs(fact: DataFrame, changed: DataFrame, window_days: int = V.ATTRIBUTION_WINDOW_DAYS) -> DataFrame:
    """(user, day) pairs of ``fact`` that some changed order (user_pseudo_id, order_date) lies 0..window days after."""
    span = changed.agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi")).first()
    if span.lo is None:
        return fact.select(*PAIR).limit(0)
    days = F.col("data_date").between(span.lo - _dt.timedelta(days=window_days), span.hi)  # prunes partitions of the fact
    pairs = fact.filter(days & F.col("user_pseudo_id").isNotNull()).select(*PAIR).distinct()
    return range_semi_join(pairs, changed.select("user_pseudo_id", "order_date").distinct(),
                           "user_pseudo_id", "event_date", "order_date", 0, window_days)


def apply_order_changes(spark: SparkSession, fact: DataFrame, orders: DataFrame, changed: DataFrame, attribution_path: str,
                        metrics_path: str, window_days: int = V.ATTRIBUTION_WINDOW_DAYS) -> list[_dt.date]:
    """Bring both tables to the state of ``orders``; the days that were rewritten.

    ``changed`` holds (user_pseudo_id, order_date) of every order that came,
    went or changed, in its old and its new state.  ``fact`` must have
    ``data_date`` = ``event_date``, as curated by day.  New rows are staged
    before a partition is replaced, so a lost executor or a rerun after a
    failure leaves a table that the same call completes.
    """
    reached = materialize(reached_pairs(fact, changed, window_days), "reached")
    days = sorted(r.event_date for r in reached.select("event_date").distinct().collect())  # days, not rows
    if days:
        part = fact.filter(F.col("data_date").isin(days)).join(reached, PAIR, "left_semi")
        bought = orders.join(reached.select("user_pseudo_id").distinct(), "user_pseudo_id", "left_semi")
        fresh = etl.search_order_attribution(part, bought, window_days)
        table = spark.read.schema(fresh.schema).parquet(attribution_path).filter(F.col("event_date").isin(days))
        staged = materialize(fresh.unionByName(table.join(reached, PAIR, "left_anti")), "attribution-days")
        for rows, path in ((staged, attribution_path), (etl.search_metrics_daily(staged), metrics_path)):
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)
        remove(staged)
    remove(reached)
    return days
