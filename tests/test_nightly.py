"""The nightly chain end to end: load, attribution, mart and DQ for one day."""

from collections import Counter
import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from queryscope.operators import etl, quality
from queryscope.plans import nightly
from queryscope.sources import fixtures as fx

AS_OF = dt.date(2024, 1, 16)
STAMP = dt.datetime(2024, 1, 16, 2, 0)


def test_run_nightly(spark, tmp_path):
    raw = fx.raw_ga4_events(spark, SF001)
    orders = fx.orders(spark, SF001)
    path = str(tmp_path / "fact")
    out = nightly.run_nightly(spark, raw, orders, path, AS_OF, STAMP, table_name="search_events_fact_t")
    day = AS_OF - dt.timedelta(days=1)
    _, cat = nightly.build_fact_input(raw, AS_OF, STAMP)
    want_fact = etl.to_fact(cat, AS_OF)
    assert Counter(out["fact"].collect()) == Counter(want_fact.collect())
    assert out["fact"].count() > 0
    assert Counter(spark.table("search_events_fact_t").select(*want_fact.columns).collect()) == Counter(want_fact.collect())
    assert {r.status for r in out["dq_duplicates"].collect()} == {"PASS"}
    assert {r.status for r in out["dq_nulls"].collect()} == {"PASS"}
    rc = out["dq_record_count"].collect()[0]
    src = etl.flatten_event_params(etl.scan_daily_shard(raw, AS_OF)).count()
    assert (rc.curated_records, rc.source_records, rc.status) == (out["fact"].count(), src, "PASS")
    # the two checks from the load job's counts equal those over the written day, and read no file
    for name, want in (("dq_record_count", quality.dq_record_count(out["fact"], src)), ("dq_nulls", quality.dq_nulls(out["fact"]))):
        assert out[name].collect() == want.collect() and out[name].dtypes == want.dtypes
        assert "FileScan" not in out[name]._jdf.queryExecution().executedPlan().toString()
    plan = out["dq_duplicates"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_timestamp:bigint,user_pseudo_id:string>" in plan
    metrics = out["metrics_daily"]
    assert metrics.select("event_date").distinct().collect()[0][0] == day
    assert metrics.agg(F.sum("total_searches")).collect()[0][0] == out["attribution"].count()
    # Rerunning the same night replaces the partition instead of appending.
    n = out["fact"].count()
    again = nightly.run_nightly(spark, raw, orders, path, AS_OF, STAMP)
    assert again["fact"].count() == n


def test_attribution_reads_only_its_fact_partitions(spark, tmp_path):
    raw = fx.raw_ga4_events(spark, SF001)
    path = str(tmp_path / "fact")
    for as_of in (AS_OF, AS_OF + dt.timedelta(days=1)):
        _, cat = nightly.build_fact_input(raw, as_of, STAMP)
        etl.incremental_load(cat, path, as_of)
    day = AS_OF - dt.timedelta(days=1)
    recent = etl.read_fact(spark, path).filter(F.col("data_date").between(day, day))
    a = etl.search_order_attribution(recent, fx.orders(spark, SF001))
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_date" in plan and "data_date#" in plan
    assert a.select("event_date").distinct().collect()[0][0] == day


def test_a_night_without_rows_fails_its_null_check(spark, tmp_path):
    raw = fx.raw_ga4_events(spark, SF001)
    out = nightly.run_nightly(spark, raw, fx.orders(spark, SF001), str(tmp_path / "fact"), dt.date(1999, 1, 2), STAMP)
    assert out["dq_nulls"].collect() == quality.dq_nulls(out["fact"]).collect()
    assert [r.status for r in out["dq_nulls"].collect()] == ["FAIL"]
    assert tuple(out["dq_record_count"].collect()[0])[1:3] == (0, 0)
