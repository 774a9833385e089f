"""Engagement analyzer (A2, A4, E1–E7) as distributed aggregates.

The reference pulls the whole date range into one pandas frame; here every
step is a grouped aggregate over the event table and the report bundle is a
dict of DataFrames.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.functions import vocab as V
from queryscope.functions.exprs import float_percent_text, ratio0, safe_ratio

LOADED_COLUMNS = ["user_pseudo_id", "event_date", "event_timestamp", "search_term",
                  "search_result_count", "event_name", "event_label", "event_category",
                  "click_position", "session_id"]


def load_search_events(events: DataFrame, start: _dt.date, end: _dt.date,
                       ordered: bool = False) -> DataFrame:
    """A2: search-category events in [start, end] (inclusive), 10 columns.

    The reference's ORDER BY only fixes the pandas row order; sorting is a
    sink option here (``ordered=True``).
    """
    df = events.filter((F.col("event_category") == V.SEARCH_CATEGORY)
                       & F.col("event_date").between(F.lit(start), F.lit(end))).select(*LOADED_COLUMNS)
    return df.orderBy("user_pseudo_id", "event_timestamp") if ordered else df


def ordering_users(orders: DataFrame, start: _dt.date, end: _dt.date) -> DataFrame:
    """A4: distinct users with an order in [start, end] (the intended, formatted query)."""
    return (orders.filter(F.col("order_date").between(F.lit(start), F.lit(end)))
                  .select("user_pseudo_id").distinct())


def engagement_daily(loaded: DataFrame) -> DataFrame:
    """Daily uniques, term count, mean result count, sessions, rates.

    pandas semantics kept: NULL dates are dropped; a day without submits /
    clicks / refinements has a NULL count (NaN) while the rates fall back to 0.
    """
    name = F.col("event_name")
    g = loaded.filter(F.col("event_date").isNotNull()).groupBy("event_date").agg(
        F.count_distinct("user_pseudo_id").alias("unique_users"),
        F.count("search_term").alias("total_searches"),
        safe_ratio(F.sum("search_result_count"), F.count("search_result_count")).alias("avg_results_returned"),
        F.count_distinct("session_id").alias("unique_sessions"),
        F.nullif(F.count_if(name == V.SUBMIT), F.lit(0).cast("bigint")).alias("searches_submitted"),
        F.nullif(F.count_if(name == V.CLICK), F.lit(0).cast("bigint")).alias("clicks_on_results"),
        F.nullif(F.count_if(name == V.REFINEMENT), F.lit(0).cast("bigint")).alias("refinements"),
    )
    return g.select(
        "event_date", "unique_users", "total_searches", "avg_results_returned", "unique_sessions",
        "searches_submitted", "clicks_on_results",
        ratio0("clicks_on_results", "searches_submitted").alias("engagement_rate"),
        "refinements",
        ratio0("refinements", "searches_submitted").alias("refinement_rate"),
    ).orderBy("event_date")


def click_position_analysis(loaded: DataFrame) -> DataFrame:
    """Clicks and distinct terms per position, % of all positioned clicks.

    Rows with a NULL position are dropped (pandas groupby), and the total
    is a scalar subquery over the same filtered clicks.
    """
    clicks = loaded.filter((F.col("event_name") == V.CLICK) & F.col("click_position").isNotNull())
    total = clicks.select(F.count("user_pseudo_id")).scalar()
    g = clicks.groupBy("click_position").agg(
        F.count("user_pseudo_id").alias("total_clicks"),
        F.count_distinct("search_term").alias("unique_search_terms"),
    )
    return g.withColumn("click_percentage", safe_ratio("total_clicks", total) * 100.0) \
            .orderBy("click_position")


def search_to_conversion(loaded: DataFrame, buyers: DataFrame) -> DataFrame:
    """E5: searchers who also ordered; rate 0 when nobody searched.

    Both sides are distinct user sets, so the left join cannot fan out.
    """
    searched = loaded.select("user_pseudo_id").filter(F.col("user_pseudo_id").isNotNull()).distinct()
    b = buyers.select(F.col("user_pseudo_id").alias("_buyer")).filter(F.col("_buyer").isNotNull()).distinct()
    j = searched.join(b, F.col("user_pseudo_id") == F.col("_buyer"), "left")
    g = j.agg(F.count("user_pseudo_id").alias("total_users_searched"),
              F.count("_buyer").alias("users_converted"))
    rate = ratio0("users_converted", "total_users_searched")
    return g.select("total_users_searched", "users_converted", rate.alias("conversion_rate"),
                    float_percent_text(rate).alias("conversion_rate_pct"))


def ordered_mean(col: str) -> F.Column:
    """Mean of a small per-day column summed in sorted order (bit-reproducible)."""
    vals = F.array_sort(F.collect_list(F.col(col)))
    return F.try_divide(F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x), F.size(vals).cast("double"))


def engagement_summary(daily: DataFrame) -> DataFrame:
    """Unweighted mean of daily rates and sums of daily counts.

    ``daily`` has one row per day, so the per-report list of rates is
    bounded by the number of days in the range.
    """
    return daily.agg(
        ordered_mean("engagement_rate").alias("avg_engagement_rate"),
        ordered_mean("refinement_rate").alias("avg_refinement_rate"),
        F.sum("unique_users").alias("total_unique_users"),
        F.sum("total_searches").alias("total_searches"),
    )


def click_positions_head(positions: DataFrame, n: int = 5) -> DataFrame:
    """First ``n`` positions (by position)."""
    return positions.orderBy("click_position").limit(n)
