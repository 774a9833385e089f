"""Rewrites equal a naive form on random data."""

from collections import Counter
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from queryscope.operators import etl, metrics as C
from queryscope.plans.joins import range_left_join
from naive import naive_attribution
from test_golden import K, S, events

USERS = st.sampled_from(["a", "b", "c", None])
DAYS = st.integers(0, 70)
BASE = dt.date(2024, 1, 1)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(DAYS, USERS), min_size=1, max_size=15),
       st.lists(st.tuples(DAYS, USERS, st.integers(1, 4)), min_size=0, max_size=15))
def test_range_left_join_equals_plain_join(spark, left, right):
    ldf = spark.createDataFrame([(i, u, BASE + dt.timedelta(days=d)) for i, (d, u) in enumerate(left)],
                                "lid int, user string, day date")
    rdf = spark.createDataFrame([(i, u, BASE + dt.timedelta(days=d), v) for i, (d, u, v) in enumerate(right)],
                                "rid int, ruser string, rday date, v int")
    got = range_left_join(ldf, rdf.withColumnRenamed("ruser", "user"), "user", "day", "rday", 0, 30)
    cond = (ldf.user == rdf.ruser) & rdf.rday.between(ldf.day, F.date_add(ldf.day, 30))
    want = ldf.join(rdf, cond, "left").select("lid", "rid")
    assert Counter(got.select("lid", "rid").collect()) == Counter(want.collect())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(DAYS, USERS, st.sampled_from([S, K]), st.sampled_from(["car", "suv"]),
                          st.integers(1, 3)), min_size=1, max_size=20),
       st.lists(st.tuples(DAYS, USERS, st.integers(1, 3)), min_size=0, max_size=10))
def test_attribution_aggregate_then_join_equals_join_then_aggregate(spark, evs, ords):
    ev = events(spark, [{"d": BASE + dt.timedelta(days=d), "u": u, "n": n, "term": t, "ts": ts}
                        for d, u, n, t, ts in evs])
    fact = etl.categorize_events(ev.withColumn("event_action", F.col("event_name")).drop("click_position", "region"),
                                 None, dt.datetime(2024, 1, 1))
    orders = spark.createDataFrame(
        [(o % 2, u, BASE + dt.timedelta(days=d), o) for d, u, o in ords] * 2,  # duplicate order rows
        "order_id long, user_pseudo_id string, order_date date, product_id long"
    ).withColumn("order_value", F.lit(9.99).cast("decimal(18,2)"))
    got = etl.search_order_attribution(fact, orders)
    assert Counter(got.collect()) == Counter(naive_attribution(fact, orders).select(*got.columns).collect())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), USERS, st.sampled_from([S, K, "page_view"]), st.integers(1, 9)),
                min_size=1, max_size=25))
def test_c1_single_pass_equals_sets_of_users(spark, evs):
    ev = events(spark, [{"d": BASE + dt.timedelta(days=d), "u": u, "n": n, "ts": ts} for d, u, n, ts in evs])
    searching = ev.filter(F.col("event_category") == "global search")
    of = lambda name: {(r.event_date, r.user_pseudo_id) for r in searching.filter(F.col("event_name") == name).collect()}
    submits, clicks = of(S), of(K)
    want = Counter()
    for day in {d for d, _ in submits}:
        users = {u for d, u in submits if d == day and u is not None}
        want[day, len(users), len({u for u in users if (day, u) in clicks})] += 1
    got = C.daily_engagement_rate(ev).select("event_date", "total_search_sessions", "engaged_sessions")
    assert Counter(map(tuple, got.collect())) == want
