"""Report bundles: the analyzers' ``generate_*_report`` as dicts of DataFrames.

Nothing is collected; the caller decides which frames to write or show.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame

from queryscope.operators import engagement as E, zero as Z


def engagement_report(events: DataFrame, start: _dt.date, end: _dt.date,
                      orders: DataFrame | None = None) -> dict[str, DataFrame]:
    loaded = E.load_search_events(events, start, end)
    daily = E.engagement_daily(loaded)
    out = {
        "daily_metrics": daily,
        "click_position_analysis": E.click_position_analysis(loaded),
        "summary": E.engagement_summary(daily),
    }
    if orders is not None:
        out["conversion_metrics"] = E.search_to_conversion(loaded, E.ordering_users(orders, start, end))
    return out


def content_gap_report(events: DataFrame, start: _dt.date, end: _dt.date) -> dict[str, DataFrame]:
    zero = Z.load_zero_result_searches(events, start, end)
    trend = Z.zero_result_trend(events, start, end)
    return {
        "top_zero_result_terms": Z.top_zero_result_terms(zero),
        "regional_analysis": Z.zero_results_by_region(zero),
        "category_breakdown": Z.categorize_zero_results(zero),
        "trend_over_time": trend,
        "summary": Z.content_gap_summary(zero, trend),
    }
