"""The nightly chain: shard scan -> flatten -> dedupe -> categorize -> load
-> attribution -> daily mart -> quality checks.

Each step is a pure operator; the disk boundaries are those of the
reference (curated fact, attribution table, daily mart), which also cut
the lineage for every step that reads them afterwards.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from queryscope.operators import etl, quality
from queryscope.session import shared_path
from queryscope.sources.sinks import write_table


def build_fact_input(raw: DataFrame, as_of: _dt.date | None,
                     processed_at: _dt.datetime | None) -> tuple[DataFrame, DataFrame]:
    """(flattened source, categorized rows) for one day, or all days when ``as_of`` is None."""
    shard = raw if as_of is None else etl.scan_daily_shard(raw, as_of)
    flat = etl.flatten_event_params(shard)
    return flat, etl.categorize_events(etl.dedupe_events(flat), as_of, processed_at)


def run_nightly(spark: SparkSession, raw: DataFrame, orders: DataFrame, fact_path: str,
                as_of: _dt.date, processed_at: _dt.datetime | None = None,
                attribution_days: int = 1, out_dir: str | None = None,
                table_name: str | None = None) -> dict[str, DataFrame]:
    """Load ``as_of - 1`` into the fact at ``fact_path`` and derive the marts.

    Like the reference, the attribution and the daily mart are written as
    tables (``{out_dir}/search_order_attribution``, ``…/search_metrics_daily``;
    default: a fresh folder under the shared folder).  The mart is
    ``etl.search_metrics_from_orders`` over the written fact: it joins (user,
    day) pairs with daily order totals, so it neither waits for the
    attribution rows nor reads them.

    ``table_name`` also registers the fact in the catalog (A6, created only
    if absent) and shows it the loaded partition.  ``attribution_days`` > 1 re-attributes a trailing range of data dates
    (orders arrive after the search; a nightly run sees only orders up to
    the run date, so late orders are picked up by re-running the range).
    """
    out_dir = out_dir or shared_path(spark, "nightly")
    shard = etl.scan_daily_shard(raw, as_of)
    # The counts of the record-count and NULL checks are observed while the
    # load job runs; only the duplicate check reads the written day (two columns).
    seen = Observation("source_rows")
    flat = etl.flatten_event_params(shard).observe(seen, F.count(F.lit(1)).alias("n"))
    categorized = etl.categorize_events(etl.dedupe_events(flat), as_of, processed_at)
    if table_name:
        etl.create_fact_table(spark, fact_path, table_name)
    loaded = etl.incremental_load(categorized, fact_path, as_of)
    if table_name:
        etl.sync_fact_table(spark, table_name)
    # An empty load may have been planned without its source, and nothing was observed there.
    source_rows = seen.get["n"] if loaded["n"] else etl.flatten_event_params(shard).count()
    day = as_of - _dt.timedelta(days=1)
    first = day - _dt.timedelta(days=attribution_days - 1)
    recent = etl.read_fact(spark, fact_path).filter(F.col("data_date").between(first, day))
    attribution_path = f"{out_dir.rstrip('/')}/search_order_attribution"
    write_table(etl.search_order_attribution(recent, orders), attribution_path)
    attribution = spark.read.parquet(attribution_path)
    metrics_path = f"{out_dir.rstrip('/')}/search_metrics_daily"
    write_table(etl.search_metrics_from_orders(recent, orders, day), metrics_path)
    fact_day = etl.read_fact(spark, fact_path, day)
    counts = quality.as_row(spark, loaded)
    return {
        "fact": fact_day,
        "attribution": attribution,
        "metrics_daily": spark.read.parquet(metrics_path),
        "dq_duplicates": quality.dq_duplicates(fact_day),
        "dq_record_count": quality.record_check(counts, F.lit(source_rows).cast("bigint")),
        "dq_nulls": quality.null_check(counts),
    }
