"""measures(df, dims, names) equals a literal SQL form of each measure on random data."""

import datetime as dt
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from queryscope.operators import measures as M
from test_golden import K, R, S, events

SQL = {
    "total_searches": "COUNT(CASE WHEN event_name = '{S}' THEN 1 END)",
    "total_clicks": "COUNT(CASE WHEN event_name = '{K}' THEN 1 END)",
    "engagement_rate": "COALESCE(CAST(COUNT(CASE WHEN event_name = '{K}' THEN 1 END) AS DOUBLE) / "
                       "NULLIF(COUNT(CASE WHEN event_name = '{S}' THEN 1 END), 0), 0.0)",
    "unique_search_users": "COUNT(DISTINCT CASE WHEN event_name = '{S}' THEN user_pseudo_id END)",
    "avg_results_returned": "AVG(CASE WHEN event_name = '{S}' THEN search_result_count END)",
    "total_refinements": "COUNT(CASE WHEN event_name = '{R}' THEN 1 END)",
    "zero_result_searches": "COUNT(CASE WHEN event_name = '{S}' AND search_result_count = 0 THEN 1 END)",
    "unique_zero_result_terms": "COUNT(DISTINCT CASE WHEN event_name = '{S}' AND search_result_count = 0 "
                                "THEN search_term END)",
    "top3_click_rate": "COALESCE(CAST(COUNT(CASE WHEN event_name = '{K}' AND click_position IN (1, 2, 3) "
                       "THEN 1 END) AS DOUBLE) / NULLIF(COUNT(CASE WHEN event_name = '{K}' THEN 1 END), 0), 0.0)",
    "avg_click_position": "AVG(CASE WHEN event_name = '{K}' THEN click_position END)",
    "search_success_rate": "COALESCE(CAST(COUNT(DISTINCT CASE WHEN event_name = '{K}' THEN session_id END) "
                           "AS DOUBLE) / NULLIF(COUNT(DISTINCT CASE WHEN event_name = '{S}' THEN session_id END), 0), 0.0)",
}

EVENT = st.tuples(st.integers(0, 2), st.sampled_from(["a", "b", "c", None]), st.sampled_from([S, K, R, "page_view"]),
                  st.sampled_from([0, 3, None]), st.sampled_from(["x", "y", None]),
                  st.sampled_from(["results|1|/p", "results|5|/p", "results", "search|default"]),
                  st.sampled_from(["s1", "s2", "s3"]), st.sampled_from(["US", "GB", None]))


@settings(max_examples=10, deadline=None)
@given(st.lists(EVENT, min_size=1, max_size=30),
       st.lists(st.sampled_from(sorted(SQL)), min_size=1, max_size=5, unique=True),
       st.sampled_from([[], ["region"], ["event_date", "device_category"]]))
def test_measures_equal_literal_sql(spark, rows, names, dims):
    ev = events(spark, [{"d": dt.date(2024, 1, 1 + d), "u": u, "n": n, "cnt": c, "term": t, "label": lab,
                         "sess": ss, "cc": cc} for d, u, n, c, t, lab, ss, cc in rows])
    got = M.measures(ev, dims, names)
    ev.createOrReplaceTempView("m_ev")
    cols = ", ".join(dims + [SQL[n].format(S=S, K=K, R=R) + f" AS {n}" for n in names])
    group = f" GROUP BY {', '.join(dims)}" if dims else ""
    want = spark.sql(f"SELECT {cols} FROM m_ev{group}")
    assert Counter(got.collect()) == Counter(want.select(*got.columns).collect())
