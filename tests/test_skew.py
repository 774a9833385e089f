"""A user holding a third of all rows: results stay exact when AQE splits the skew."""

from collections import Counter
import datetime as dt

from pyspark.sql import functions as F

from queryscope.operators import etl, metrics as C
from naive import naive_attribution
from test_golden import K, S, events

BASE = dt.date(2024, 1, 1)


def skewed(spark):
    rows = []
    for i in range(900):
        u = "hot" if i % 3 == 0 else f"u{i % 97}"
        rows.append({"d": BASE + dt.timedelta(days=i % 60), "u": u, "n": S if i % 4 else K,
                     "term": f"t{i % 13}", "ts": i})
    ev = events(spark, rows)
    orders = spark.createDataFrame(
        [(i, "hot" if i % 2 == 0 else f"u{i % 97}", BASE + dt.timedelta(days=i % 75), i % 7) for i in range(400)],
        "order_id long, user_pseudo_id string, order_date date, product_id long",
    ).withColumn("order_value", F.lit(12.5).cast("decimal(18,2)"))
    fact = etl.categorize_events(ev.withColumn("event_action", F.col("event_name")).drop("click_position", "region"),
                                 None, dt.datetime(2024, 1, 1))
    return fact, orders


def test_attribution_exact_under_forced_skew_join(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact, orders = skewed(spark)
        got = etl.search_order_attribution(fact, orders)
        rows = Counter(got.collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert rows == Counter(naive_attribution(fact, orders).select(*got.columns).collect())
        assert "SortMergeJoin" in plan and "skew=true" in plan
        c1 = {r.event_date: r.total_search_sessions for r in C.daily_engagement_rate(fact.withColumn(
            "event_category", F.lit("global search"))).collect()}
        assert sum(c1.values()) == fact.filter(F.col("event_name") == S) \
            .select("event_date", "user_pseudo_id").distinct().count()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_attribution_runs_no_job_while_it_is_built(spark):
    fact, orders = skewed(spark)
    spark.sparkContext.setJobGroup("building", "attribution")
    try:
        etl.search_metrics_daily(etl.search_order_attribution(fact, orders))
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_daily_mart_is_the_same_from_attribution_rows_and_from_orders(spark):
    fact, orders = skewed(spark)
    orders = orders.unionByName(orders.limit(30))  # repeated order rows count once
    rows = etl.search_metrics_daily(etl.search_order_attribution(fact, orders)).collect()
    assert Counter(etl.search_metrics_from_orders(fact, orders).collect()) == Counter(rows)
