"""Nightly ETL: GA4 export -> curated fact -> attribution -> daily mart.

Row-local steps (flatten, categorize) use higher-order and CASE
expressions only: no explode, no shuffle.  The shuffles are the dedupe
(partial aggregation absorbs duplicate-heavy groups map-side), the
attribution join and the mart aggregation.
"""

from __future__ import annotations

import calendar
import datetime as _dt
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from queryscope.functions import vocab as V
from queryscope.functions.exprs import (
    click_position_of,
    pct2,
    region_of,
    search_type_of,
)
from queryscope.operators import quality
from queryscope.plans.joins import range_left_join

# Columns of the flattened view and of the deduplication (13 each).
FLAT_COLUMNS = [
    "event_date", "event_timestamp", "event_name", "user_pseudo_id", "event_category",
    "event_action", "event_label", "search_term", "search_result_count", "page_name",
    "country_code", "device_category", "traffic_source",
]

# Curated fact table DDL (15 columns, partitioned by data_date).
FACT_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("search_term", T.StringType()),
    T.StructField("search_result_count", T.IntegerType()),
    T.StructField("search_type", T.StringType()),
    T.StructField("click_position", T.IntegerType()),
    T.StructField("is_zero_result", T.IntegerType()),
    T.StructField("country_code", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("device_category", T.StringType()),
    T.StructField("traffic_source", T.StringType()),
    T.StructField("etl_processed_at", T.TimestampNTZType()),
    T.StructField("data_date", T.DateType()),
])
FACT_COLUMNS = [f.name for f in FACT_SCHEMA.fields]

# The grouping of the attribution table.
ATTRIBUTION_KEYS = ["event_date", "user_pseudo_id", "search_term", "search_type",
                    "country_code", "region"]
ORDER_COLUMNS = ["order_id", "order_date", "order_value", "product_id"]


def _day(as_of: _dt.date, back: int = 1) -> _dt.date:
    return as_of - _dt.timedelta(days=back)


# ------------------------------------------------------------------ A1 / B1

def scan_daily_shard(raw: DataFrame, as_of: _dt.date) -> DataFrame:
    """A1: the export shard of the day before ``as_of``.

    On a table partitioned by ``event_date`` this is a partition filter
    (``PartitionFilters`` in the scan); on a flat table a pushed filter.
    Shards landed by suffix are read with ``sources.shards.read_daily_shard``.
    """
    return raw.filter(F.col("event_date") == F.lit(_day(as_of)))


def param(key: str, field: str = "string_value") -> Column:
    """Value of the first ``event_params`` entry with ``key``; NULL if absent."""
    hit = F.filter("event_params", lambda p: p["key"] == F.lit(key))
    return F.get(hit, 0)["value"][field]


def flatten_event_params(raw: DataFrame, category: str | None = V.SEARCH_CATEGORY) -> DataFrame:
    """B1: event params -> columns, struct fields -> columns, category filter.

    A missing key yields NULL; a duplicated key yields its first value.
    The category filter applies to the projected column (the reference's
    WHERE on a SELECT alias).
    """
    flat = raw.select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id",
        param("event_category").alias("event_category"),
        param("event_action").alias("event_action"),
        param("event_label").alias("event_label"),
        param("search_term").alias("search_term"),
        param("search_result_count", "int_value").try_cast("int").alias("search_result_count"),
        param("page_name").alias("page_name"),
        F.col("geo.country").alias("country_code"),
        F.col("device.category").alias("device_category"),
        F.col("traffic_source.source").alias("traffic_source"),
    )
    if category is not None:
        flat = flat.filter(F.col("event_category") == category)
    return flat


# ------------------------------------------------------------------ B2 / B3

def dedupe_events(flat: DataFrame) -> DataFrame:
    """B2: drop rows without timestamp or user, then DISTINCT over 13 columns."""
    return (flat.filter(F.col("event_timestamp").isNotNull() & F.col("user_pseudo_id").isNotNull())
                .select(*FLAT_COLUMNS).distinct())


def categorize_events(deduped: DataFrame, as_of: _dt.date | None,
                      processed_at: _dt.datetime | None = None) -> DataFrame:
    """B3a–e: search_type, click_position, is_zero_result, region, ETL stamps.

    ``data_date`` is the processing day (``as_of - 1``), not the event day.
    With ``as_of=None`` (a back-fill over many days) each row gets the day
    a nightly run would have given it: its own ``event_date``.
    """
    if as_of is None and processed_at is None:
        raise ValueError("a back-fill needs an explicit processed_at")
    stamp = processed_at or _dt.datetime.combine(as_of, _dt.time())
    data_date = F.col("event_date") if as_of is None else F.lit(_day(as_of))
    return deduped.select(
        "*",
        search_type_of("event_label").alias("search_type"),
        click_position_of("event_label", "event_name").alias("click_position"),
        F.when(F.col("search_result_count") == 0, 1).otherwise(0).alias("is_zero_result"),
        region_of("country_code").alias("region"),
        # parsed from text: a wall-clock TIMESTAMP_NTZ independent of any time zone
        F.to_timestamp_ntz(F.lit(stamp.isoformat(sep=" "))).alias("etl_processed_at"),
        data_date.alias("data_date"),
    )


def to_fact(categorized: DataFrame, as_of: _dt.date | None) -> DataFrame:
    """The 15 DDL columns by name (not by position), one ``data_date`` or all."""
    if as_of is not None:
        categorized = categorized.filter(F.col("data_date") == F.lit(_day(as_of)))
    return categorized.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA.fields])


# ------------------------------------------------------------------ A6 / B4 / B5

def create_fact_table(spark: SparkSession, path: str, name: str = "search_events_fact") -> None:
    """Register the curated table (parquet, partitioned by data_date) if absent."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in FACT_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet "
              f"PARTITIONED BY (data_date) LOCATION '{path}'")


def sync_fact_table(spark: SparkSession, name: str = "search_events_fact") -> None:
    """Make the catalog table show the partitions that a load by path added or removed."""
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def incremental_load(categorized: DataFrame, path: str, as_of: _dt.date,
                     max_records_per_file: int = 5_000_000) -> dict[str, int | None]:
    """Write one ``data_date`` partition, replacing only that partition; the counts of D2 and D3.

    The counts (``n`` rows and ``quality.null_counts``) are observed while
    the rows are written, so these checks read nothing back.

    Dynamic partition overwrite makes a rerun idempotent (the reference
    appends, so a rerun doubles the day).  The day is written straight from
    the upstream partitions (no repartition by ``data_date``, which would
    funnel a whole day through one task); ``max_records_per_file`` bounds
    the file size.  Dynamic overwrite touches only partitions with rows, so
    a day that turned out empty has its old partition removed afterwards.
    """
    seen = Observation(f"loaded-{uuid.uuid4().hex[:8]}")
    fact = to_fact(categorized, as_of).observe(seen, F.count(F.lit(1)).alias("n"), *quality.null_counts())
    (fact.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max_records_per_file)
         .partitionBy("data_date").parquet(path))
    counts = seen.get
    if counts["n"] == 0:
        remove_partitions(categorized.sparkSession, path, [_day(as_of)])
    return counts


def remove_partitions(spark: SparkSession, path: str, days: list[_dt.date]) -> None:
    """Delete the ``data_date`` partitions of ``days`` from the table at ``path``."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    for day in days:
        p = hadoop.Path(f"{path.rstrip('/')}/data_date={day.isoformat()}")
        p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def expire_partitions(spark: SparkSession, path: str, as_of: _dt.date,
                      months: int = V.RETENTION_CURATED_MONTHS) -> list[_dt.date]:
    """B5 on storage: remove the ``data_date`` partitions beyond the horizon; the days removed.

    The days come from the listing of the table's files; none is opened.
    """
    files = spark.read.schema(FACT_SCHEMA).parquet(path).inputFiles()
    listed = {day[1] for day in (re.search(r"/data_date=(\d{4}-\d\d-\d\d)/", f) for f in files) if day}
    month = as_of.year * 12 + as_of.month - 1 - months
    year, month = month // 12, month % 12 + 1
    horizon = _dt.date(year, month, min(as_of.day, calendar.monthrange(year, month)[1]))
    days = sorted(day for day in map(_dt.date.fromisoformat, listed) if day < horizon)
    remove_partitions(spark, path, days)
    return days


def read_fact(spark: SparkSession, path: str, data_date: _dt.date | None = None) -> DataFrame:
    df = spark.read.schema(FACT_SCHEMA).parquet(path)
    if data_date is not None:
        df = df.filter(F.col("data_date") == F.lit(data_date))
    return df


def retention_filter(df: DataFrame, as_of: _dt.date, months: int = V.RETENTION_CURATED_MONTHS,
                     date_col: str = "data_date") -> DataFrame:
    """Rows inside the retention horizon (13 months curated, 3 months raw)."""
    return df.filter(F.col(date_col) >= F.add_months(F.lit(as_of), -months))


# ------------------------------------------------------------------ B6 / B7

def search_groups(fact: DataFrame) -> DataFrame:
    """One row per (event_date, user, term, type, country, region): the search side of B6."""
    return fact.groupBy(*ATTRIBUTION_KEYS).agg(
        F.count_distinct("event_timestamp").alias("search_count"),
        F.max(F.when(F.col("event_name") == V.CLICK, 1).otherwise(0)).alias("clicked_result"),
        F.max("is_zero_result").alias("had_zero_result"),
    )


def search_order_attribution(fact: DataFrame, orders: DataFrame,
                             window_days: int = V.ATTRIBUTION_WINDOW_DAYS) -> DataFrame:
    """Search groups LEFT JOIN orders placed 0..30 days after the search day.

    The reference joins every event to every order of its user and then
    groups.  All grouped measures depend only on the event side and the
    range condition only on the group's ``event_date``, so grouping first
    and joining the (deduplicated) orders afterwards gives identical rows
    while the join input shrinks to one row per search group.  The range
    join is bucketed by time and can be split on either side
    (``plans.joins.range_left_join``).
    """
    groups = search_groups(fact)
    o = orders.select("user_pseudo_id", *ORDER_COLUMNS).distinct()
    j = range_left_join(groups, o, "user_pseudo_id", "event_date", "order_date",
                        0, window_days)
    return j.select(
        *ATTRIBUTION_KEYS, "search_count", "clicked_result", "had_zero_result", *ORDER_COLUMNS,
        F.datediff(F.col("order_date"), F.col("event_date")).alias("days_to_conversion"),
    )


def search_metrics_daily(attribution: DataFrame, day: _dt.date | None = None) -> DataFrame:
    """12 measures per (event_date, region, country_code).

    The two COUNT(DISTINCT user) measures are computed without Expand by
    grouping on (keys, user) first; both levels aggregate partially, so a
    hot day/country is combined map-side.  ``total_revenue`` keeps the
    reference's fan-out (an order counts once per attribution group).
    """
    a = attribution if day is None else attribution.filter(F.col("event_date") == F.lit(day))
    rows = a.withColumn("w", F.lit(1)).withColumn("has", F.col("order_id").isNotNull()).withColumn("rev", F.col("order_value"))
    return _daily_mart(rows)


def search_metrics_from_orders(fact: DataFrame, orders: DataFrame, day: _dt.date | None = None,
                               window_days: int = V.ATTRIBUTION_WINDOW_DAYS) -> DataFrame:
    """B7 without the attribution rows: the same mart, linear in searches and orders.

    A search group with k orders in reach has max(1, k) attribution rows,
    all alike but for the order; so the groups are weighted by max(1, k) and
    worth the sum of these orders.  k and the sum come from a range join of
    distinct (user, search day) pairs with per-day order totals.
    """
    groups = search_groups(fact if day is None else fact.filter(F.col("event_date") == F.lit(day)))
    days = (orders.select("user_pseudo_id", *ORDER_COLUMNS).distinct().groupBy("user_pseudo_id", "order_date")
            .agg(F.count(F.lit(1)).alias("k"), F.sum("order_value").alias("v")))
    pairs = groups.filter(F.col("user_pseudo_id").isNotNull()).select("user_pseudo_id", "event_date").distinct()
    reach = (range_left_join(pairs, days, "user_pseudo_id", "event_date", "order_date", 0, window_days)
             .groupBy("user_pseudo_id", "event_date").agg(F.sum("k").alias("k"), F.sum("v").alias("rev")))
    rows = (groups.join(reach, ["user_pseudo_id", "event_date"], "left")
            .withColumn("w", F.greatest(F.lit(1), F.coalesce("k", F.lit(0))))
            .withColumn("has", F.coalesce(F.col("k") > 0, F.lit(False))))
    return _daily_mart(rows)


def _daily_mart(rows: DataFrame) -> DataFrame:
    """Measures over rows of weight ``w`` with ``has`` (an order) and ``rev`` (its value)."""
    keys = ["event_date", "region", "country_code"]
    st, w = F.col("search_type"), F.col("w")
    of = lambda kind: F.sum(F.when(st == kind, w).otherwise(0))
    per_user = rows.groupBy(*keys, "user_pseudo_id").agg(
        F.sum(w).alias("n"),
        F.sum(F.col("clicked_result") * w).alias("c"),
        F.sum(F.col("had_zero_result") * w).alias("z"),
        of("default_search").alias("t1"),
        of("auto_suggestion").alias("t2"),
        of("keyword_box").alias("t3"),
        F.max("has").alias("has_order"),
        F.sum("rev").alias("rev"),
    )
    m = per_user.groupBy(*keys).agg(
        F.count("user_pseudo_id").alias("unique_users"),
        F.sum("n").alias("total_searches"),
        F.sum("c").alias("searches_with_clicks"),
        F.sum("z").alias("zero_result_searches"),
        F.sum("t1").alias("default_searches"),
        F.sum("t2").alias("auto_suggestion_searches"),
        F.sum("t3").alias("keyword_box_searches"),
        F.count(F.when(F.col("has_order"), F.col("user_pseudo_id"))).alias("users_with_orders"),
        F.sum("rev").alias("total_revenue"),
    )
    return m.select(
        *keys, "unique_users", "total_searches",
        F.col("searches_with_clicks").cast("bigint").alias("searches_with_clicks"),
        pct2("searches_with_clicks", "total_searches").alias("engagement_rate_pct"),
        F.col("zero_result_searches").cast("bigint").alias("zero_result_searches"),
        pct2("zero_result_searches", "total_searches").alias("zero_result_rate_pct"),
        "default_searches", "auto_suggestion_searches", "keyword_box_searches",
        "users_with_orders",
        F.col("total_revenue").cast("double").alias("total_revenue"),
        pct2("users_with_orders", "unique_users").alias("conversion_rate_pct"),
    )


def revenue_dedup(attribution: DataFrame, day: _dt.date | None = None) -> DataFrame:
    """Companion to B7: revenue with each order counted once per (date, region, country)."""
    a = attribution if day is None else attribution.filter(F.col("event_date") == F.lit(day))
    keys = ["event_date", "region", "country_code"]
    per_order = (a.filter(F.col("order_id").isNotNull())
                  .groupBy(*keys, "order_id").agg(F.max("order_value").alias("v")))
    return per_order.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("distinct_orders"),
        F.sum("v").cast("double").alias("total_revenue_dedup"),
    )
