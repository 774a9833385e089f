"""Dashboard page marts (M36–M38): the measure compositions per page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.functions.exprs import ratio0
from queryscope.operators import impute, measures as M, zero


def executive_mart(events: DataFrame, orders: DataFrame) -> DataFrame:
    """M36 (page 1): Engagement Rate %, Search Conversion %, Total Searches, Unique Search Users."""
    conv = M.search_conversion_rate(events, orders).select("search_conversion_pct")
    base = M.measures(events, [], ["engagement_rate_pct", "total_searches", "unique_search_users"])
    return base.select("engagement_rate_pct", conv.scalar().alias("search_conversion_pct"),
                       "total_searches", "unique_search_users")


def behavior_mart(events: DataFrame, zero_loaded: DataFrame) -> dict[str, DataFrame]:
    """M37 (page 2): Zero Result Rate %, top zero-result terms, click distribution."""
    rate = M.measures(events, [], ["zero_result_rate_pct"])
    return {
        "zero_result_rate": rate,
        "top_zero_result_terms": zero.top_zero_result_terms(zero_loaded),
        "click_distribution": M.clicks_at_position(events).withColumn(
            "zero_result_rate_pct", rate.select("zero_result_rate_pct").scalar()),
    }


def regional_mart(events: DataFrame, sales: DataFrame) -> DataFrame:
    """M38 (page 3): Regional Search Volume, Sales per Search, Data Quality Status by region.

    One grouped pass over the sales serves the totals and the quality.  A
    region present on one side only still gets a row: its missing measures
    are BLANK, and a region without sales rows has NULL share 0 (Complete).
    """
    sps = M.sales_per_search(impute.sales_groups(sales), events)
    pct = F.coalesce(ratio0("null_sales_count", "rows"), F.lit(0.0))
    return sps.select("region", "regional_search_volume", "sales_per_search",
                      M.data_quality_status(pct).alias("data_quality_status"))
