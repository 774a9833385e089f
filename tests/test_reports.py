"""Report bundles and the page-2 mart hold the same frames as the registered queries."""

from collections import Counter

import __spark_entry__ as E
from conftest import SF001
from queryscope.params import REPORT_END, REPORT_START
from queryscope.plans import marts, reports
from queryscope.operators import zero as Z
from queryscope.sources import fixtures as fx


def same(a, b):
    return Counter(a.collect()) == Counter(b.select(*a.columns).collect())


def test_engagement_report_bundle(spark):
    ev, q = fx.canonical_events(spark, SF001), E.queries()
    rep = reports.engagement_report(ev, REPORT_START, REPORT_END, fx.orders(spark, SF001))
    assert set(rep) == {"daily_metrics", "click_position_analysis", "summary", "conversion_metrics"}
    assert same(rep["daily_metrics"], q["engagement_daily"](spark, SF001))
    assert same(rep["click_position_analysis"], q["click_position_analysis"](spark, SF001))
    assert same(rep["summary"], q["engagement_summary"](spark, SF001))
    assert same(rep["conversion_metrics"], q["search_to_conversion"](spark, SF001))
    assert "conversion_metrics" not in reports.engagement_report(ev, REPORT_START, REPORT_END)


def test_content_gap_report_bundle(spark):
    ev, q = fx.canonical_events(spark, SF001), E.queries()
    rep = reports.content_gap_report(ev, REPORT_START, REPORT_END)
    pairs = {"top_zero_result_terms": "top_zero_result_terms", "regional_analysis": "zero_results_by_region",
             "category_breakdown": "categorize_zero_results", "trend_over_time": "zero_result_trend",
             "summary": "content_gap_summary"}
    assert set(rep) == set(pairs)
    for k, key in pairs.items():
        assert same(rep[k], q[key](spark, SF001)), k


def test_behavior_mart_frames(spark):
    ev = fx.canonical_events(spark, SF001)
    zero = Z.load_zero_result_searches(ev, REPORT_START, REPORT_END)
    m = marts.behavior_mart(ev, zero)
    assert set(m) == {"zero_result_rate", "top_zero_result_terms", "click_distribution"}
    assert same(m["click_distribution"], E.queries()["mart_behavior"](spark, SF001))
    rate = m["zero_result_rate"].collect()[0][0]
    assert {r.zero_result_rate_pct for r in m["click_distribution"].collect()} == {rate}
