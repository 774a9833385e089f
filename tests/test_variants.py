"""Same-named metrics with different definitions give different numbers."""

import datetime as dt

from pyspark.sql import functions as F

from queryscope.operators import engagement as E, measures as M, metrics as C
from queryscope.sources.sinks import write_table
from test_golden import K, R, S, events


def test_engagement_rate_variants_differ(spark):
    # user a: 2 submits, 3 clicks in one session; user b: 1 submit, no click (other session)
    ev = events(spark, [{"u": "a", "sess": "s1"}, {"u": "a", "sess": "s1"},
                        {"u": "a", "n": K, "sess": "s1"}, {"u": "a", "n": K, "sess": "s1"},
                        {"u": "a", "n": K, "sess": "s1"}, {"u": "b", "sess": "s2"}])
    users = C.daily_engagement_rate(ev).collect()[0].engagement_rate_pct          # clicking users / submitting users
    rows = E.engagement_daily(ev).collect()[0].engagement_rate                      # click rows / submit rows
    dax = M.measures(ev, [], ["engagement_rate"]).collect()[0][0]                   # same as rows, any context
    sessions = M.measures(ev, [], ["search_success_rate"]).collect()[0][0]          # click sessions / submit sessions
    assert (users, rows, dax, sessions) == (50.0, 1.0, 1.0, 0.5)


def test_refinement_rate_variants_differ(spark):
    ev = events(spark, [{"u": "a"}, {"u": "a"}, {"u": "b"}, {"u": "b", "n": R}])
    sql = C.daily_refinement_rate(ev).collect()[0].refinement_rate_pct    # (user, day) with > 1 submit
    py = E.engagement_daily(ev).collect()[0].refinement_rate              # refinement events / submits
    sess = M.multi_search_sessions(ev, []).collect()[0][0]               # sessions with > 1 submit
    assert (sql, py, sess) == (50.0, 1 / 3, 1)


def test_zero_result_variants_differ(spark):
    ev = events(spark, [{"n": P, "cnt": 0, "page": "search result page", "term": "a"},
                        {"n": S, "cnt": 0, "term": "b"}, {"n": K, "cnt": 0, "term": "c"}])
    top = {r.search_term for r in C.zero_result_terms_top(ev, dt.date(2024, 1, 20)).collect()}
    submits = M.measures(ev, [], ["zero_result_searches"]).collect()[0][0]
    assert top == {"a"} and submits == 1


P = "page_view"


def test_write_table_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path)
    write_table(spark.range(3).withColumn("d", F.lit("x")), path, ["d"])
    back = spark.read.parquet(path)
    assert back.count() == 3 and set(back.columns) == {"id", "d"}
