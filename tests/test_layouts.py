"""Stored forms: user-day buckets, clustered fact, mergeable sales, sorted daily counts."""

from collections import Counter
import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from queryscope.functions import vocab as V
from queryscope.operators import engagement, etl, impute, measures, metrics, quality, sales_state, top_terms
from queryscope.plans import nightly, user_days
from queryscope.sources import fixtures as fx
from queryscope.sources.sinks import write_clustered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_user_measures_join_without_exchange(spark, tmp_path, no_broadcast):
    ev, orders = fx.canonical_events(spark, SF001), fx.orders(spark, SF001)
    u, o = (user_days.save_by_user(df, f"{n}_{uuid.uuid4().hex[:6]}", str(tmp_path / n), 8)
            for n, df in (("ud", user_days.user_days(ev)), ("od", user_days.order_days(orders))))
    as_of, start, end = dt.date(2024, 2, 10), dt.date(2024, 1, 5), dt.date(2024, 1, 25)
    loaded = engagement.load_search_events(ev, start, end)
    cases = [(user_days.conversion_funnel(u, o, as_of), metrics.conversion_funnel(ev, orders, as_of)),
             (user_days.search_to_conversion(u, o, start, end), engagement.search_to_conversion(loaded, engagement.ordering_users(orders, start, end))),
             (user_days.search_conversion_rate(u, o), measures.search_conversion_rate(ev, orders))]
    for fast, plain in cases:
        assert fast.collect() == plain.select(*fast.columns).collect()
        text = plan(fast)
        assert "hashpartitioning" not in text and "SortMergeJoin" in text
        assert "hashpartitioning" in plan(plain)


def rows_scanned(df):
    """Rows that the parquet scan gave out, from its own metrics."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().startswith("Scan parquet"):
            n += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_one_user_skips_row_groups(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(5000))).alias("user_pseudo_id"), F.col("id").alias("event_timestamp"),
        F.when(F.col("id") % 2 == 0, F.lit(dt.date(2024, 1, 1))).otherwise(F.lit(dt.date(2024, 1, 2))).alias("data_date"))
    flat, clustered = str(tmp_path / "flat"), str(tmp_path / "clustered")
    rows.repartition(4).write.partitionBy("data_date").option("parquet.block.size", 64 << 10).parquet(flat)
    write_clustered(rows, clustered, files=8, distinct_keys=1000, row_group_bytes=64 << 10)
    one = [spark.read.parquet(p).filter((F.col("user_pseudo_id") == "u77") & (F.col("data_date") == F.lit(dt.date(2024, 1, 1)))) for p in (flat, clustered)]
    assert Counter(one[0].select("event_timestamp").collect()) == Counter(one[1].select("event_timestamp").collect())
    assert rows_scanned(one[1]) < rows_scanned(one[0]) / 5
    assert one[1].count() > 0
    missing = spark.read.parquet(clustered).filter("user_pseudo_id = 'u77x'")  # within the range of some row group
    assert rows_scanned(missing) < 20_000


def test_clustered_fact_has_the_same_rows(spark, tmp_path):
    fact = etl.to_fact(nightly.build_fact_input(fx.raw_ga4_events(spark, SF001), None, dt.datetime(2024, 1, 16))[1], None)
    write_clustered(fact, str(tmp_path / "f"), files=6)
    assert Counter(etl.read_fact(spark, str(tmp_path / "f")).collect()) == Counter(fact.collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sales_state_of_any_range_equals_the_sales(spark, tmp_path, seed):
    r = random.Random(seed)
    sales = fx.sales(spark, SF001).withColumn("order_date", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("order_id") % 12 * 9).cast("int")))
    path, cut = str(tmp_path / "s"), dt.date(2024, 1, 1) + dt.timedelta(days=r.randint(2, 95))
    sales_state.store_days(sales.filter(F.col("order_date") <= F.lit(cut)).withColumn("sales_value", F.lit(1).cast("decimal(18,2)")), path)
    sales_state.store_days(sales.filter(F.col("order_date") <= F.lit(cut)), path)   # corrected days replace the first load
    sales_state.store_days(sales.filter(F.col("order_date") > F.lit(cut)), path)
    start = dt.date(2024, 1, 1) + dt.timedelta(days=r.randint(0, 99))
    end = start + dt.timedelta(days=r.randint(0, 60))
    some, merged = sales.filter(F.col("order_date").between(start, end)), sales_state.merged_groups(spark, path, start, end)
    for got, want in ((sales_state.product_avg(merged), impute.regional_product_avg(some)),
                      (quality.imputation_summary(merged), quality.imputation_summary(impute.sales_groups(some))),
                      (impute.total_sales_cleaned(merged, ["region"]), impute.total_sales_cleaned(impute.sales_groups(some), ["region"]))):
        assert Counter(got.collect()) == Counter(want.collect())
    assert "PartitionFilters: [isnotnull(order_month" in plan(merged)


@pytest.mark.parametrize("seed", range(4))
def test_top_terms_of_any_range_equal_the_full_count(spark, tmp_path, seed):
    r = random.Random(seed)
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    vocabulary = [None, *(f"t{i}" for i in range(300))]
    weights = [1 / (i + 1) for i in range(301)] if seed else [1] * 301   # seed 0: hardly any term stands out
    rows = [(day(r.randint(0, 9)), t) for t in r.choices(vocabulary, weights, k=4000)]
    path = str(tmp_path / "d")
    top_terms.store_daily_terms(spark.createDataFrame(rows, "event_date date, search_term string"), path, files_per_day=2)
    for _ in range(2):
        a = r.randint(0, 9)
        b, k = r.randint(a, 9), r.choice([1, 5, 20, 500])
        got, figures = top_terms.top_terms(spark, path, day(a), day(b), k)
        count = Counter(t for d, t in rows if day(a) <= d <= day(b))
        days = Counter(t for _, t in {x for x in rows if day(a) <= x[0] <= day(b)})
        want = sorted(((t, n, days[t]) for t, n in count.items()), key=lambda x: (-x[1], x[0] is not None, x[0]))[:k]
        assert [tuple(x) for x in got.collect()] == want
        assert figures["terms_looked_up"] <= figures["terms_read"] <= len(count)
        if seed and k <= 5:
            assert figures["terms_read"] < len(count) / 2
    got, figures = top_terms.top_terms(spark, path, day(50), day(60), 3)
    assert got.count() == 0 and figures["days"] == 0
