"""Streaming incremental ingest, shard layout and CSV export."""

from collections import Counter
import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from queryscope.operators import etl
from queryscope.plans import nightly
from queryscope.sources import fixtures as fx
from queryscope.sources.shards import read_daily_shard, shard_path, write_daily_shards
from queryscope.sources.sinks import export_csv
from queryscope.streaming.ingest import load_batch, start_incremental_ingest

STAMP = dt.datetime(2024, 1, 16, 2, 0)


def test_read_daily_shard_by_suffix(spark, tmp_path):
    raw = fx.raw_ga4_events(spark, SF001)
    root = str(tmp_path / "landing")
    write_daily_shards(raw, root)
    day = dt.date(2024, 1, 15)
    shard = read_daily_shard(spark, root, day + dt.timedelta(days=1))
    assert shard.count() == raw.filter(F.col("event_date") == day).count() > 0
    assert shard.count() == spark.read.parquet(shard_path(root, day)).count()
    plan = shard._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_table_suffix" in plan
    assert sorted(shard.columns) == sorted(raw.columns)


def test_streaming_ingest_equals_batch_backfill_and_is_exactly_once(spark, tmp_path):
    raw = fx.raw_ga4_events(spark, SF001)
    landing, fact, ckpt = (str(tmp_path / x) for x in ("landing", "fact", "ckpt"))
    first = raw.filter(F.col("event_date") <= dt.date(2024, 1, 15))
    first.write.parquet(landing + "/events_1")
    q = start_incremental_ingest(spark, landing, fact, ckpt, STAMP)
    q.awaitTermination(300)
    n1 = etl.read_fact(spark, fact).count()
    raw.filter(F.col("event_date") > dt.date(2024, 1, 15)).write.parquet(landing + "/events_2")
    q = start_incremental_ingest(spark, landing, fact, ckpt, STAMP)   # restart: only new files
    q.awaitTermination(300)
    got = etl.read_fact(spark, fact)
    _, cat = nightly.build_fact_input(raw, None, STAMP)
    want = etl.to_fact(cat, None)
    assert 0 < n1 < got.count()
    assert Counter(got.collect()) == Counter(want.select(*got.columns).collect())


def test_a_day_in_two_files_and_a_replay_keep_every_row(spark, tmp_path):
    raw = fx.raw_ga4_events(spark, SF001).filter(F.col("event_date") == dt.date(2024, 1, 15))
    landing, fact = str(tmp_path / "landing"), str(tmp_path / "fact")
    half = F.col("event_timestamp") % 2 == 0
    want = Counter(etl.to_fact(nightly.build_fact_input(raw, None, STAMP)[1], None).collect())
    for name, rows in (("a", raw.filter(half)), ("b", raw.filter(~half)), ("b2", raw.filter(~half))):
        rows.write.parquet(f"{landing}/{name}")
        start_incremental_ingest(spark, landing, fact, str(tmp_path / "ckpt"), STAMP, max_files=1).awaitTermination(300)
    assert Counter(etl.read_fact(spark, fact).collect()) == want
    load_batch(raw.filter(half), landing, fact, STAMP)  # a batch replayed on its own
    assert Counter(etl.read_fact(spark, fact).collect()) == want


def test_a_day_rerun_as_empty_is_cleared_and_expired_days_go(spark, tmp_path):
    raw, fact = fx.raw_ga4_events(spark, SF001), str(tmp_path / "fact")
    days = [dt.date(2024, 1, 16), dt.date(2024, 1, 17)]
    for as_of in days:
        etl.incremental_load(nightly.build_fact_input(raw, as_of, STAMP)[1], fact, as_of)
    assert etl.read_fact(spark, fact).select("data_date").distinct().count() == 2
    etl.incremental_load(nightly.build_fact_input(raw.limit(0), days[0], STAMP)[1], fact, days[0])
    assert [r[0] for r in etl.read_fact(spark, fact).select("data_date").distinct().collect()] == [dt.date(2024, 1, 16)]
    assert etl.expire_partitions(spark, fact, dt.date(2025, 1, 28)) == []
    assert etl.expire_partitions(spark, fact, dt.date(2025, 3, 1)) == [dt.date(2024, 1, 16)]
    assert etl.read_fact(spark, fact).count() == 0


def test_export_csv_has_header_and_all_rows(spark, tmp_path):
    df = spark.range(25).withColumn("x", F.col("id") * 2)
    out = str(tmp_path / "csv")
    export_csv(df, out)
    back = spark.read.option("header", True).csv(out)
    assert back.columns == ["id", "x"] and back.count() == 25
