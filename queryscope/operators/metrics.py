"""Behavioural search metrics (the reference's ad-hoc SQL metric set, C1–C5).

Input: canonical ``SearchEvents`` (see ``sources.fixtures.with_derived``).
All windows are relative to an explicit ``as_of`` date instead of
CURRENT_DATE, so runs are reproducible.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.functions import vocab as V
from queryscope.functions.exprs import (
    click_position_of,
    date_minus_days,
    pct2,
    round2_avg,
    round2_money_avg,
)


def _search(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_category") == V.SEARCH_CATEGORY)


def daily_engagement_rate(events: DataFrame) -> DataFrame:
    """Users per day with a result click ÷ users per day with a submit.

    The reference joins two grouped sets on (date, user); the same numbers
    come from one grouping on (date, user) with two flags followed by a
    grouping on date — two partial/final aggregations, no join, no Expand.
    A NULL user never counts but its date row survives (rate NULL).
    """
    per_user = (
        _search(events)
        .filter(F.col("event_name").isin(V.SUBMIT, V.CLICK))
        .groupBy("event_date", "user_pseudo_id")
        .agg(F.max(F.col("event_name") == V.SUBMIT).alias("submitted"),
             F.max(F.col("event_name") == V.CLICK).alias("clicked"))
        .filter("submitted")
    )
    out = per_user.groupBy("event_date").agg(
        F.count("user_pseudo_id").alias("total_search_sessions"),
        F.count(F.when(F.col("clicked"), F.col("user_pseudo_id"))).alias("engaged_sessions"),
    )
    return out.withColumn(
        "engagement_rate_pct", pct2("engaged_sessions", "total_search_sessions")
    ).orderBy(F.col("event_date").desc())


def zero_result_terms_top(events: DataFrame, as_of: _dt.date, top_n: int = V.TOP_ZERO_TERMS_SQL,
                          days: int = V.METRIC_WINDOW_DAYS) -> DataFrame:
    """Most frequent zero-result terms on the result page in the last 30 days.

    A NULL term is a group of its own.  Top-k runs as a per-partition
    take-ordered followed by one merge (no global sort).
    """
    zero = _search(events).filter(
        (F.col("event_name") == V.PAGE_VIEW)
        & (F.col("page_name") == V.RESULT_PAGE)
        & (F.col("search_result_count") == 0)
        & (F.col("event_date") >= date_minus_days(as_of, days))
    )
    agg = zero.groupBy("search_term").agg(
        F.count(F.lit(1)).alias("zero_result_count"),
        F.count_distinct("user_pseudo_id").alias("affected_users"),
        F.count_distinct("event_date").alias("days_occurring"),
    )
    return agg.orderBy(F.col("zero_result_count").desc(),
                       F.col("search_term").asc_nulls_first()).limit(top_n)


def conversion_funnel(events: DataFrame, orders: DataFrame, as_of: _dt.date,
                      days: int = V.METRIC_WINDOW_DAYS) -> DataFrame:
    """Submitters in the window LEFT JOIN ordering users in the window.

    Both sides are reduced to one row per user before the join, so the join
    is between two distinct-user sets (no event × order fan-out).
    """
    since = date_minus_days(as_of, days)
    searchers = (
        _search(events)
        .filter((F.col("event_name") == V.SUBMIT) & (F.col("event_date") >= since))
        .select("user_pseudo_id").filter(F.col("user_pseudo_id").isNotNull()).distinct()
    )
    buyers = (
        orders.filter(F.col("order_date") >= since)
        .groupBy("user_pseudo_id")
        .agg(F.count_distinct("order_id").alias("order_count"),
             F.sum("order_value").alias("total_revenue"))
        .withColumnRenamed("user_pseudo_id", "buyer")
    )
    j = searchers.join(buyers, F.col("user_pseudo_id") == F.col("buyer"), "left")
    return funnel_row(j)


def funnel_row(j: DataFrame) -> DataFrame:
    """The funnel's measures over searchers with their buyer, orders and revenue (null: none)."""
    agg = j.agg(
        F.count("user_pseudo_id").alias("total_search_users"),
        F.count("buyer").alias("users_with_orders"),
        F.sum("order_count").alias("total_orders"),
        F.sum("total_revenue").alias("_rev"),
        F.count("total_revenue").alias("_n"),
    )
    return agg.select(
        "total_search_users", "users_with_orders",
        pct2("users_with_orders", "total_search_users").alias("conversion_rate_pct"),
        "total_orders",
        round2_money_avg("_rev", "_n").alias("avg_revenue_per_converting_user"),
    )


def click_position_by_label(events: DataFrame, as_of: _dt.date,
                            days: int = V.METRIC_WINDOW_DAYS) -> DataFrame:
    """C4: clicks per (label, position) with share of all clicks.

    The grand total is a scalar subquery (one distributed aggregate to a
    single value) instead of ``SUM(COUNT(*)) OVER ()``, which would pull
    every group into one partition.
    """
    clicks = _search(events).filter(
        (F.col("event_name") == V.CLICK) & (F.col("event_date") >= date_minus_days(as_of, days))
    ).withColumn("click_position", click_position_of("event_label", None))
    total = clicks.select(F.count(F.lit(1))).scalar()
    agg = clicks.groupBy("event_label", "click_position").agg(
        F.count(F.lit(1)).alias("click_count"),
        F.count_distinct("user_pseudo_id").alias("unique_users"),
    )
    return agg.withColumn("click_share_pct", pct2("click_count", total)) \
              .orderBy(F.col("click_position").asc_nulls_first(), "event_label")


def daily_refinement_rate(events: DataFrame) -> DataFrame:
    """Share of (user, day) groups with more than one submit.

    The NULL user forms one group per day and is counted, as in SQL.
    """
    per_user = (
        _search(events).filter(F.col("event_name") == V.SUBMIT)
        .groupBy("user_pseudo_id", "event_date")
        .agg(F.count(F.lit(1)).alias("search_count"))
    )
    out = per_user.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum(F.when(F.col("search_count") > 1, 1).otherwise(0)).alias("sessions_with_refinement"),
        F.sum("search_count").alias("_searches"),
    )
    return out.select(
        "event_date", "total_sessions", "sessions_with_refinement",
        pct2("sessions_with_refinement", "total_sessions").alias("refinement_rate_pct"),
        round2_avg("_searches", "total_sessions").alias("avg_searches_per_session"),
    ).orderBy(F.col("event_date").desc())
