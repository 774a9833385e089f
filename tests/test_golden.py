"""Golden micro-tables for the NULL / ANSI / rounding / tie traps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from queryscope.functions import exprs as X
from queryscope.operators import etl, engagement as E, impute, measures as M, metrics as C, quality as Q
from queryscope.operators import zero as Z
from queryscope.sources import fixtures as fx

D1 = dt.date(2024, 1, 10)
D2 = dt.date(2024, 1, 11)
EV_SCHEMA = ("event_date date, event_timestamp bigint, event_name string, user_pseudo_id string, "
             "event_category string, event_label string, search_term string, search_result_count int, "
             "page_name string, session_id string, country_code string, device_category string, "
             "traffic_source string")
S, K, R, P = "global_search_submit", "global_search_click_result", "global_search_refinement", "page_view"


def events(spark, rows):
    full = []
    for r in rows:
        r = dict(r)
        full.append((r.get("d", D1), r.get("ts", 1), r.get("n", S), r.get("u", "u1"), r.get("cat", "global search"),
                     r.get("label", "search|default"), r.get("term", "car"), r.get("cnt", 5), r.get("page"),
                     r.get("sess", "s1"), r.get("cc", "US"), "desktop", "google"))
    return fx.with_derived(spark.createDataFrame(full, EV_SCHEMA))


def test_pct2_is_exact_half_up(spark):
    rows = [(1, 3), (2, 3), (1, 800), (1, 8000), (0, 5), (5, 0), (7, None), (1005, 100000)]
    df = spark.createDataFrame(rows, "n bigint, d bigint").select(X.pct2("n", "d").alias("p"))
    assert [r.p for r in df.collect()] == [33.33, 66.67, 0.13, 0.01, 0.0, None, None, 1.01]


def test_pct_text_and_ratio0(spark):
    df = spark.createDataFrame([(1, 8), (0, 0), (1, 3), (2, 3)], "a bigint, b bigint")
    out = df.select(X.pct_text("a", "b", 1).alias("t"), X.ratio0("a", "b").alias("r")).collect()
    assert [r.t for r in out] == ["12.5%", "0.0%", "33.3%", "66.7%"]
    assert out[1].r == 0.0


def test_click_position_malformed_label_is_null(spark):
    ev = events(spark, [{"n": K, "label": "results"}, {"n": K, "label": "results|x|/p"},
                        {"n": K, "label": "results|3|/p/1"}, {"n": S, "label": "results|4|/p"}])
    assert [r.click_position for r in ev.collect()] == [None, None, 3, None]


def test_region_buckets_null_is_other(spark):
    ev = events(spark, [{"cc": "CA"}, {"cc": "SE"}, {"cc": "KR"}, {"cc": "BR"}, {"cc": None}])
    assert [r.region for r in ev.collect()] == ["North America", "Europe", "Asia", "Other", "Other"]


def test_norm_term_strips_unicode_whitespace(spark):
    df = spark.createDataFrame([(" Car\t",), (" SUV　",), (None,)], "t string")
    assert [r.x for r in df.select(X.norm_term("t").alias("x")).collect()] == ["car", "suv", None]


def test_c1_null_user_day_survives_with_null_rate(spark):
    ev = events(spark, [{"u": "a"}, {"u": "a", "n": K}, {"u": "b"}, {"d": D2, "u": None},
                        {"d": D2, "u": None, "n": K}])
    out = {r.event_date: r for r in C.daily_engagement_rate(ev).collect()}
    assert (out[D1].total_search_sessions, out[D1].engaged_sessions, out[D1].engagement_rate_pct) == (2, 1, 50.0)
    assert (out[D2].total_search_sessions, out[D2].engaged_sessions, out[D2].engagement_rate_pct) == (0, 0, None)


def test_c5_null_user_counts_as_a_session(spark):
    ev = events(spark, [{"u": None}, {"u": None}, {"u": "a"}])
    r = C.daily_refinement_rate(ev).collect()[0]
    assert (r.total_sessions, r.sessions_with_refinement, r.refinement_rate_pct, r.avg_searches_per_session) == \
        (2, 1, 50.0, 1.5)


def _raw(spark, params):
    schema = ("event_date date, event_timestamp bigint, event_name string, user_pseudo_id string, "
              "event_params array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>, "
              "geo struct<country:string>, device struct<category:string>, traffic_source struct<source:string>")
    return spark.createDataFrame([(D1, 1, S, "u1", params, ("US",), ("mobile",), ("google",))], schema)


def test_flatten_missing_key_null_duplicate_key_first(spark):
    params = [("event_category", ("global search", None)), ("search_term", ("first", None)),
              ("search_term", ("second", None)), ("search_result_count", (None, 7))]
    r = etl.flatten_event_params(_raw(spark, params)).collect()[0]
    assert (r.search_term, r.search_result_count, r.page_name, r.country_code) == ("first", 7, None, "US")
    other = [("event_category", ("navigation", None))]
    assert etl.flatten_event_params(_raw(spark, other)).count() == 0


def test_dedupe_drops_nulls_and_exact_copies(spark):
    ev = events(spark, [{}, {}, {"u": None}, {"ts": 2}]).withColumn("event_action", F.col("event_name"))
    assert etl.dedupe_events(ev).count() == 2


def test_incremental_load_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "fact")
    raw = fx.raw_ga4_events(spark, "/root/testdata/sf0.001")
    as_of = dt.date(2024, 1, 16)

    def load(day):
        _, cat = __import__("queryscope.plans.nightly", fromlist=["x"]).build_fact_input(
            raw, day, dt.datetime(2024, 1, 16))
        etl.incremental_load(cat, path, day)
    load(as_of)
    once = etl.read_fact(spark, path).count()
    load(as_of + dt.timedelta(days=1))
    load(as_of)
    fact = etl.read_fact(spark, path)
    assert fact.filter(F.col("data_date") == dt.date(2024, 1, 15)).count() == once
    assert fact.select("data_date").distinct().count() == 2
    plan = fact.filter(F.col("data_date") == dt.date(2024, 1, 15))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_date" in plan


def test_dq_empty_input_fails(spark):
    empty = events(spark, [{}]).limit(0)
    r = Q.dq_nulls(empty).collect()[0]
    assert (r.null_users, r.status) == (None, "FAIL")
    assert Q.dq_duplicates(empty).collect()[0].status == "PASS"


def test_dq_duplicates_ignores_null_pairs(spark):
    ev = events(spark, [{"u": None}, {"u": None}, {}, {}])
    assert Q.dq_duplicates(ev).collect()[0].duplicate_count == 3


def test_impute_null_keys_and_all_null_groups_stay_null(spark):
    sales = spark.createDataFrame(
        [(1, D1, "EU", 1, "p", "p", 10.0), (2, D1, "EU", 1, "p", "p", None), (3, D1, None, 1, "p", "p", None),
         (4, D1, None, 1, "p", "p", 4.0), (5, D1, "EU", 2, "q", "q", None)],
        "order_id long, order_date date, region string, product_id long, product_name string, "
        "search_term string, sales_value double").withColumn("sales_value", F.col("sales_value").cast("decimal(18,2)"))
    got = {r.order_id: (r.sales_value, r.is_imputed, r.regional_sample_size)
           for r in impute.impute_sales(sales).collect()}
    assert got == {1: (10.0, 0, 1), 2: (10.0, 1, 1), 3: (None, 1, None), 4: (4.0, 0, None), 5: (None, 1, None)}
    dax = {r.order_id: r.regional_sales_clean for r in impute.regional_sales_clean(sales).collect()}
    assert dax[3] == 4.0 and dax[5] is None  # BLANK keys group together in the dashboard version


def test_e1_missing_counts_are_null_but_rates_zero(spark):
    ev = events(spark, [{"n": K}, {"d": D2}, {"d": D2, "n": R}])
    out = {r.event_date: r for r in E.engagement_daily(ev).collect()}
    assert (out[D1].searches_submitted, out[D1].clicks_on_results, out[D1].engagement_rate) == (None, 1, 0.0)
    assert (out[D2].refinements, out[D2].refinement_rate, out[D1].refinements) == (1, 1.0, None)


def test_z5_substring_or_swallows_words(spark):
    df = spark.createDataFrame([("horsepower",), ("Orange",), ("tesla price",), ("mpg",), ("suv",),
                                ("red car",), ("",), (None,), ("Tesla",)], "search_term string")
    got = [r.c for r in df.select(Z.term_category("search_term").alias("c")).collect()]
    assert got == ["Comparison Query", "Comparison Query", "Pricing Query", "Feature/Spec Query",
                   "Single Word (Broad)", "Other", "Other", "Other", "Single Word (Broad)"]
    wb = [r.c for r in df.select(Z.term_category("search_term", True).alias("c")).collect()]
    assert wb[:2] == ["Feature/Spec Query", "Single Word (Broad)"]


def test_dax_zero_result_blank_as_zero(spark):
    ev = events(spark, [{"cnt": 0}, {"cnt": None}, {"cnt": 3}])
    sql = M.measures(ev, [], ["zero_result_searches"]).collect()[0][0]
    dax = M.measures(ev, [], ["zero_result_searches"], blank_as_zero=True).collect()[0][0]
    assert (sql, dax) == (1, 2)


def test_mom_blank_previous_month(spark):
    ev = events(spark, [{"d": dt.date(2024, 1, 5)}, {"d": dt.date(2024, 1, 6), "n": K},
                        {"d": dt.date(2024, 3, 1)}, {"d": dt.date(2024, 3, 2)}])
    got = {r.month: r for r in M.searches_mom(ev).collect()}
    feb, mar = dt.date(2024, 2, 1), dt.date(2024, 3, 1)
    assert got[feb].total_searches is None and got[feb].mom_growth == -1.0
    assert got[mar].previous_total_searches is None and got[mar].mom_growth == 0.0
    eng = {r.month: r for r in M.engagement_mom(ev).collect()}
    assert eng[dt.date(2024, 1, 1)].engagement_rate == 1.0 and eng[feb].engagement_rate_change == -1.0


@pytest.mark.parametrize("pct,label", [(0.0, "✅ Complete"), (0.05, "⚠️ Minor Issues (<5%)"),
                                       (0.10, "⚠️ Moderate Issues (5-15%)"), (0.2, "🔴 Major Issues (>15%)")])
def test_data_quality_status(spark, pct, label):
    df = spark.createDataFrame([(pct,)], "p double")
    assert df.select(M.data_quality_status(F.col("p"))).collect()[0][0] == label
