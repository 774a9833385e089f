"""Measures by any dimensions, percent texts and totals at their limits."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from queryscope.functions.exprs import div_half_up, float_percent_text
from queryscope.operators import impute, measures as M
from queryscope.registry import QUERIES
from queryscope.sources import fixtures as fx


def test_float_percent_text_is_python(spark):
    pairs = [(1, 800), (3, 800), (5, 800), (7, 800), (1, 3), (2, 3), (149, 150), (0, 7), (7, 7), (29, 20000), (57, 40000)]
    pairs += [(a, b) for b in (160, 331, 800, 1999, 8000) for a in range(0, b, 7)]
    df = spark.createDataFrame(pairs, "a int, b int")
    rows = df.select("a", "b", float_percent_text(F.col("a") / F.col("b")).alias("t")).collect()
    assert [(r.a, r.b, r.t) for r in rows if r.t != f"{r.a / r.b:.2%}"] == []


def test_money_average_far_beyond_bigint_cents(spark):
    r = spark.range(1).select(div_half_up(F.lit(10 ** 17).cast("decimal(38,0)") * 100, F.lit(1000)).alias("x")).collect()[0]
    assert r.x == 10 ** 16


def test_region_volume_without_region_is_the_whole(spark):
    ev = fx.canonical_events(spark, SF001)
    total = M.measures(ev, [], ["total_searches"]).collect()[0][0]
    assert {r.regional_search_volume for r in M.regional_search_volume(ev, ["device_category"]).collect()} == {total}
    by = {r.region: r.regional_search_volume for r in M.regional_search_volume(ev, ["region", "device_category"]).collect()}
    assert sum(by.values()) == total


def test_month_over_month_by_region_adds_up(spark):
    ev = fx.monthly_events(spark, SF001)
    whole = {r.month: r.total_searches for r in M.searches_mom(ev).collect()}
    parts: dict[dt.date, int] = {}
    for r in M.searches_mom(ev, ["region"]).collect():
        parts[r.month] = parts.get(r.month, 0) + (r.total_searches or 0)
    assert parts == whole


def test_sales_per_search_and_conversion_are_inside_their_range(spark):
    rows = QUERIES["sales_per_search"](spark, SF001).collect()
    assert len([r for r in rows if r.sales_per_search and r.sales_per_search > 0]) >= 4
    conv = QUERIES["search_conversion_rate"](spark, SF001).collect()[0]
    assert 0.1 < conv.search_conversion_rate < 0.9


def test_sales_are_joined_up_once(spark):
    for key in ("imputation_summary", "total_sales_cleaned", "mart_regional"):
        df = QUERIES[key](spark, SF001)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("l_orderkey") and plan.count("lineitem") <= 1 and plan.count("Relation [l_") <= 1, key


def test_grouped_totals_equal_row_level_cleaning(spark):
    sales = fx.sales(spark, SF001)
    rows = impute.regional_sales_clean(sales).groupBy("region").agg(F.round(F.sum("regional_sales_clean"), 2).alias("t")).collect()
    got = {r.region: r.total_sales_cleaned for r in impute.total_sales_cleaned(impute.sales_groups(sales), ["region"]).collect()}
    assert got == {r.region: r.t for r in rows}


def test_terms_grow_with_the_parts(spark):
    n = [fx.canonical_events(spark, f"/root/testdata/sf{sf}").select("search_term").distinct().count() for sf in ("0.001", "0.01")]
    assert n[1] > 1.5 * n[0]
