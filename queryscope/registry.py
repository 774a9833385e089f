"""Registered queries: key -> callable(spark, sf_dir) -> DataFrame.

Each entry reads the driver tables under ``sf_dir`` (through the fixture
"""

from __future__ import annotations

from collections.abc import Callable

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryscope.functions import vocab as V
from queryscope.operators import engagement as E
from queryscope.operators import delta, distinct, etl, impute, quality, sales_state, top_terms, typos
from queryscope.operators import measures as M
from queryscope.operators import metrics as C
from queryscope.operators.typo_index import TypoIndex
from queryscope.operators import zero as Z
from queryscope.params import (AS_OF_30D, AS_OF_ETL, ETL_PROCESSED_AT, REPORT_END, REPORT_START,
                               RETENTION_AS_OF, RETENTION_CURATED_AS_OF)
from queryscope.plans import marts, nightly, user_days
from queryscope.session import shared_path
from queryscope.sources import fixtures as fx
from queryscope.sources.external import ExternalSource, read_external
from queryscope.sources.shards import write_daily_shards
from queryscope.sources.sinks import export_csv, write_clustered, write_table
from queryscope.streaming.ingest import start_incremental_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- C1–C5

@register("daily_engagement_rate")
def _c1(spark, sf):
    return C.daily_engagement_rate(fx.canonical_events(spark, sf))


@register("zero_result_terms_top50")
def _c2(spark, sf):
    return C.zero_result_terms_top(fx.canonical_events(spark, sf), AS_OF_30D)


@register("conversion_funnel")
def _c3(spark, sf):
    return C.conversion_funnel(fx.canonical_events(spark, sf), fx.orders(spark, sf), AS_OF_30D)


def _user_tables(spark, sf):
    tables = (user_days.user_days(fx.canonical_events(spark, sf)), user_days.order_days(fx.orders(spark, sf)))
    return [user_days.save_by_user(t, f"{name}_{uuid.uuid4().hex[:8]}", shared_path(spark, name), 16)
            for name, t in zip(("user_days", "order_days"), tables)]


@register("conversion_funnel_by_user_days")
def _c3_days(spark, sf):
    return user_days.conversion_funnel(*_user_tables(spark, sf), AS_OF_30D)


@register("search_to_conversion_by_user_days")
def _e5_days(spark, sf):
    return user_days.search_to_conversion(*_user_tables(spark, sf), REPORT_START, REPORT_END)


@register("search_conversion_rate_by_user_days")
def _m16_days(spark, sf):
    return user_days.search_conversion_rate(*_user_tables(spark, sf))


@register("zero_result_terms_range")
def _c2_range(spark, sf):
    """Top 50 of a range that no table was built for, from daily counts."""
    path = shared_path(spark, "daily-terms")
    ev = fx.canonical_events(spark, sf)
    top_terms.store_daily_terms(ev.filter((F.col("event_category") == V.SEARCH_CATEGORY) & (F.col("event_name") == V.PAGE_VIEW)
                                          & (F.col("page_name") == V.RESULT_PAGE) & (F.col("search_result_count") == 0)), path)
    return top_terms.top_terms(spark, path, REPORT_START, REPORT_END, V.TOP_ZERO_TERMS_SQL)[0]


@register("click_position_by_label")
def _c4(spark, sf):
    return C.click_position_by_label(fx.canonical_events(spark, sf), AS_OF_30D)


@register("daily_refinement_rate")
def _c5(spark, sf):
    return C.daily_refinement_rate(fx.canonical_events(spark, sf))


# ---------------------------------------------------------------- A1, A6, B1–B7, D1–D3

def _etl_day(spark, sf, dups: bool = False):
    flat = fx.events_with_duplicates(spark, sf) if dups else fx.search_events(spark, sf)
    return fx.raw_ga4_events(spark, sf, flat)


def _backfill_fact(spark, sf):
    """Curated fact over every day of the input (data_date = event day)."""
    raw = _etl_day(spark, sf, dups=True)
    _, cat = nightly.build_fact_input(raw, None, ETL_PROCESSED_AT)
    return etl.to_fact(cat, None)


@register("scan_daily_shard")
def _a1(spark, sf):
    shard = etl.scan_daily_shard(_etl_day(spark, sf), AS_OF_ETL)
    return shard.select("event_date", "event_timestamp", "event_name", "user_pseudo_id",
                        F.size("event_params").alias("n_params"),
                        F.col("geo.country").alias("country_code"),
                        F.col("device.category").alias("device_category"),
                        F.col("traffic_source.source").alias("traffic_source"))


@register("flatten_event_params")
def _b1(spark, sf):
    return etl.flatten_event_params(_etl_day(spark, sf))


@register("dedupe_events")
def _b2(spark, sf):
    return etl.dedupe_events(etl.flatten_event_params(_etl_day(spark, sf, dups=True)))


@register("categorize_events")
def _b3(spark, sf):
    return nightly.build_fact_input(_etl_day(spark, sf, dups=True), None, ETL_PROCESSED_AT)[1]


@register("fact_roundtrip")
def _a6(spark, sf):
    path = shared_path(spark, "search_events_fact")
    _backfill_fact(spark, sf).write.partitionBy("data_date").parquet(path)
    return etl.read_fact(spark, path)


@register("fact_clustered")
def _a6_clustered(spark, sf):
    """The fact ordered by user within its days, with bloom filters."""
    path = shared_path(spark, "search_events_fact")
    write_clustered(_backfill_fact(spark, sf), path)
    return etl.read_fact(spark, path)


@register("fact_table")
def _a6_table(spark, sf):
    """Two nights loaded into a catalog table, read by its name."""
    path, name = shared_path(spark, "search_events_fact"), f"search_events_fact_{uuid.uuid4().hex[:8]}"
    etl.create_fact_table(spark, path, name)
    raw = _etl_day(spark, sf, dups=True)
    for as_of in (AS_OF_ETL, AS_OF_ETL + _dt.timedelta(days=1)):
        stamp = _dt.datetime.combine(as_of, ETL_PROCESSED_AT.time())
        etl.incremental_load(nightly.build_fact_input(raw, as_of, stamp)[1], path, as_of)
    etl.sync_fact_table(spark, name)
    return spark.table(name)


@register("incremental_load_late")
def _b4_late(spark, sf):
    """Every day arrives in two files on two nights, the second exported twice."""
    raw = _etl_day(spark, sf)
    landing, path, seen = (shared_path(spark, x) for x in ("landing", "search_events_fact", "ingest-checkpoint"))
    early = F.col("event_timestamp") % 3 == 0
    for name, rows in (("a", raw.filter(early)), ("b", raw.filter(~early)), ("c", raw.filter(~early))):
        write_daily_shards(rows, landing, "append")
        if name != "b":
            start_incremental_ingest(spark, landing, path, seen, ETL_PROCESSED_AT).awaitTermination()
    return etl.read_fact(spark, path)


@register("incremental_load")
def _b4(spark, sf):
    """Load day 1, day 2, then day 1 again: the table must hold each day once."""
    path = shared_path(spark, "search_events_fact")
    raw = _etl_day(spark, sf, dups=True)
    day2 = AS_OF_ETL + _dt.timedelta(days=1)
    for as_of in (AS_OF_ETL, day2, AS_OF_ETL):
        stamp = _dt.datetime.combine(as_of, ETL_PROCESSED_AT.time())
        _, cat = nightly.build_fact_input(raw, as_of, stamp)
        etl.incremental_load(cat, path, as_of)
    return etl.read_fact(spark, path)


@register("retention_filter")
def _b5(spark, sf):
    return etl.retention_filter(fx.monthly_events(spark, sf), RETENTION_AS_OF,
                                months=V.RETENTION_RAW_MONTHS, date_col="event_date")


@register("retention_curated")
def _b5_curated(spark, sf):
    """Expired partitions are removed; what is left of the table is read."""
    path = shared_path(spark, "search_events_fact")
    fx.monthly_events(spark, sf).withColumn("data_date", F.col("event_date")).select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id", "data_date").write.partitionBy("data_date").parquet(path)
    etl.expire_partitions(spark, path, RETENTION_CURATED_AS_OF)
    return spark.read.parquet(path).withColumn("data_date", F.col("data_date").cast("date"))


@register("replace_table")
def _a7(spark, sf):
    """The daily mart replaces an older table of the same place."""
    path = shared_path(spark, "search_metrics_daily")
    write_table(C.daily_refinement_rate(fx.canonical_events(spark, sf)), path)
    write_table(C.daily_engagement_rate(fx.canonical_events(spark, sf)), path)
    return spark.read.parquet(path)


@register("csv_export")
def _a8(spark, sf):
    path = shared_path(spark, "engagement_csv")
    daily = E.engagement_daily(_loaded(spark, sf))
    export_csv(daily, path)
    return spark.read.schema(daily.schema).option("header", True).csv(path)


@register("external_orders")
def _a5(spark, sf):
    """Orders exported by another system: its own separator, dates, decimal comma and column names."""
    path = shared_path(spark, "external-orders")
    fx.orders(spark, sf).select(
        F.col("order_id").alias("No"), F.col("user_pseudo_id").alias("Buyer"), F.date_format("order_date", "dd.MM.yyyy").alias("Day"),
        F.translate(F.col("order_value").cast("string"), ".", ",").alias("Total"), F.col("product_id").alias("Item"),
    ).write.option("sep", ";").option("header", True).csv(path)
    return read_external(spark, ExternalSource(
        "csv", path, {"sep": ";", "header": "true"}, schema="No string, Buyer string, Day string, Total string, Item string",
        columns={"order_id": "No", "user_pseudo_id": "Buyer", "order_date": "to_date(Day, 'dd.MM.yyyy')",
                 "order_value": "translate(Total, ',', '.')", "product_id": "Item"}))


def _after_late_orders(spark, sf):
    """Tables built before some orders came and others were corrected, then brought up to date."""
    fact_path, attribution, metrics = (shared_path(spark, x) for x in ("search_events_fact", "search_order_attribution", "search_metrics_daily"))
    _backfill_fact(spark, sf).write.partitionBy("data_date").parquet(fact_path)
    fact, orders = etl.read_fact(spark, fact_path), fx.orders(spark, sf)
    kind = F.col("order_id") % 10
    before = orders.filter(kind != 3).withColumn("order_date", F.when(kind == 4, F.date_sub("order_date", 5)).otherwise(F.col("order_date"))) \
        .withColumn("order_value", F.when(kind == 4, F.lit(0)).otherwise(F.col("order_value")).cast("decimal(18,2)"))
    delta.build_tables(fact, before, attribution, metrics)
    changed = orders.filter(kind.isin(3, 4)).unionByName(before.filter(kind == 4)).select("user_pseudo_id", "order_date")
    delta.apply_order_changes(spark, fact, orders, changed, attribution, metrics)
    return attribution, metrics


@register("attribution_after_late_orders")
def _b6_delta(spark, sf):
    return spark.read.parquet(_after_late_orders(spark, sf)[0])


@register("search_metrics_after_late_orders")
def _b7_delta(spark, sf):
    return spark.read.parquet(_after_late_orders(spark, sf)[1])


@register("search_order_attribution")
def _b6(spark, sf):
    return etl.search_order_attribution(_backfill_fact(spark, sf), fx.orders(spark, sf))


@register("search_metrics_daily")
def _b7(spark, sf):
    return etl.search_metrics_from_orders(_backfill_fact(spark, sf), fx.orders(spark, sf))


@register("revenue_dedup")
def _b7b(spark, sf):
    return etl.revenue_dedup(
        etl.search_order_attribution(_backfill_fact(spark, sf), fx.orders(spark, sf)))


@register("dq_duplicates")
def _d1(spark, sf):
    # Checked on the flattened input before dedupe, where duplicates exist.
    return quality.dq_duplicates(etl.flatten_event_params(_etl_day(spark, sf, dups=True)))


@register("dq_record_count")
def _d2(spark, sf):
    raw = _etl_day(spark, sf, dups=True)
    flat, _ = nightly.build_fact_input(raw, None, ETL_PROCESSED_AT)
    return quality.dq_record_count(_backfill_fact(spark, sf), flat)


@register("dq_nulls")
def _d3(spark, sf):
    return quality.dq_nulls(etl.flatten_event_params(_etl_day(spark, sf)))


# ---------------------------------------------------------------- I1–I4, D4–D7

@register("regional_product_avg")
def _i1(spark, sf):
    return impute.regional_product_avg(fx.sales(spark, sf))


@register("impute_sales")
def _i2(spark, sf):
    return impute.impute_sales(fx.sales(spark, sf))


@register("regional_sales_clean")
def _i3(spark, sf):
    return impute.regional_sales_clean(fx.sales(spark, sf))


@register("total_sales_cleaned")
def _i4(spark, sf):
    return impute.total_sales_cleaned(impute.sales_groups(fx.sales(spark, sf)), ["region"])


def _sales_state(spark, sf):
    """The sales' state, written in two loads (the second brings the later days)."""
    path, sales = shared_path(spark, "sales-state"), typos.materialize(fx.sales(spark, sf), "sales")
    half = F.col("order_date") < F.lit(_dt.date(1995, 6, 1))
    sales_state.store_days(sales.filter(half), path)
    sales_state.store_days(sales.filter(~half), path)
    return sales_state.merged_groups(spark, path)


@register("regional_product_avg_from_state")
def _i1_state(spark, sf):
    return sales_state.product_avg(_sales_state(spark, sf))


@register("total_sales_from_state")
def _i4_state(spark, sf):
    return impute.total_sales_cleaned(_sales_state(spark, sf), ["region"])


@register("imputation_summary_from_state")
def _d4_state(spark, sf):
    return quality.imputation_summary(_sales_state(spark, sf))


@register("imputation_summary")
def _d4(spark, sf):
    return quality.imputation_summary(impute.sales_groups(fx.sales(spark, sf)))


@register("sales_quality")
def _d5(spark, sf):
    return M.sales_quality(fx.sales(spark, sf), ["region"])


# ---------------------------------------------------------------- A2, A4, E1–E7

def _loaded(spark, sf):
    return E.load_search_events(fx.canonical_events(spark, sf), REPORT_START, REPORT_END)


@register("load_search_events")
def _a2(spark, sf):
    return _loaded(spark, sf)


@register("ordering_users")
def _a4(spark, sf):
    return E.ordering_users(fx.orders(spark, sf), REPORT_START, REPORT_END)


@register("engagement_daily")
def _e1(spark, sf):
    return E.engagement_daily(_loaded(spark, sf))


@register("click_position_analysis")
def _e4(spark, sf):
    return E.click_position_analysis(_loaded(spark, sf))


@register("search_to_conversion")
def _e5(spark, sf):
    return E.search_to_conversion(_loaded(spark, sf),
                                  E.ordering_users(fx.orders(spark, sf), REPORT_START, REPORT_END))


@register("engagement_summary")
def _e6(spark, sf):
    return E.engagement_summary(E.engagement_daily(_loaded(spark, sf)))


@register("click_positions_head")
def _e7(spark, sf):
    return E.click_positions_head(E.click_position_analysis(_loaded(spark, sf)))


# ---------------------------------------------------------------- A3, Z1, Z4–Z8

def _zero(spark, sf):
    return Z.load_zero_result_searches(fx.canonical_events(spark, sf), REPORT_START, REPORT_END)


@register("load_zero_result_searches")
def _a3(spark, sf):
    return _zero(spark, sf)


@register("top_zero_result_terms")
def _z1(spark, sf):
    return Z.top_zero_result_terms(_zero(spark, sf))


@register("zero_results_by_region")
def _z4(spark, sf):
    return Z.zero_results_by_region(_zero(spark, sf))


@register("categorize_zero_results")
def _z5(spark, sf):
    return Z.categorize_zero_results(_zero(spark, sf))


@register("zero_result_trend")
def _z6(spark, sf):
    return Z.zero_result_trend(fx.canonical_events(spark, sf), REPORT_START, REPORT_END)


@register("content_gap_summary")
def _z7(spark, sf):
    ev = fx.canonical_events(spark, sf)
    return Z.content_gap_summary(_zero(spark, sf), Z.zero_result_trend(ev, REPORT_START, REPORT_END))


@register("content_gap_preview")
def _z8(spark, sf):
    return Z.content_gap_preview(Z.top_zero_result_terms(_zero(spark, sf)))


# ---------------------------------------------------------------- M1–M38

@register("kpi_by_region")
def _m1(spark, sf):
    return M.measures(fx.canonical_events(spark, sf), ["region"],
                      ["total_searches", "total_clicks", "engagement_rate",
                       "unique_search_users", "avg_results_returned"])


@register("kpi_formatted")
def _m4(spark, sf):
    ev = fx.canonical_events(spark, sf)
    fmt = M.measures(ev, ["region"], ["engagement_rate_pct", "refinement_rate_pct", "zero_result_rate_pct"])
    conv = M.search_conversion_rate(ev, fx.orders(spark, sf), ["region"]).select(
        F.col("region").alias("_cregion"), "search_conversion_pct")
    j = fmt.join(conv, fmt["region"].eqNullSafe(conv["_cregion"]), "left")
    return j.select("region", "engagement_rate_pct", "refinement_rate_pct", "zero_result_rate_pct",
                    F.coalesce("search_conversion_pct", F.lit("0.0%")).alias("search_conversion_pct"))


@register("kpi_refinement")
def _m7(spark, sf):
    return M.measures(fx.canonical_events(spark, sf), ["event_date"],
                      ["total_refinements", "refinement_rate"])


@register("kpi_zero_results")
def _m10(spark, sf):
    return M.measures(fx.canonical_events(spark, sf), ["device_category"],
                      ["zero_result_searches", "zero_result_rate", "unique_zero_result_terms"])


@register("unique_users_trailing")
def _users_trailing(spark, sf):
    """Search users of the last 7 and 28 days up to each day, from daily bitmaps."""
    ev = fx.canonical_events(spark, sf).filter((F.col("event_category") == V.SEARCH_CATEGORY) & (F.col("event_name") == V.SUBMIT))
    ids = typos.materialize(distinct.numbered(ev.select("user_pseudo_id")), "user-ids")
    bitmaps = typos.materialize(distinct.daily_bitmaps(ev, ids, "user_pseudo_id", "event_date", ["region"]), "user-bitmaps")
    out = distinct.distinct_in_trailing_days(bitmaps, "event_date", [7, 28], ["region"])
    return out.withColumnRenamed("n", "unique_users")


@register("searched_users")
def _m14(spark, sf):
    return M.searched_users(fx.canonical_events(spark, sf))


@register("converted_users")
def _m15(spark, sf):
    return M.converted_users(fx.orders(spark, sf), fx.canonical_events(spark, sf))


@register("search_conversion_rate")
def _m16(spark, sf):
    return M.search_conversion_rate(fx.canonical_events(spark, sf), fx.orders(spark, sf))


@register("clicks_at_position")
def _m18(spark, sf):
    return M.clicks_at_position(fx.canonical_events(spark, sf))


@register("kpi_clicks")
def _m19(spark, sf):
    return M.measures(fx.canonical_events(spark, sf), ["device_category"],
                      ["total_clicks", "top3_click_rate", "avg_click_position"])


@register("regional_search_volume")
def _m22(spark, sf):
    return M.regional_search_volume(fx.canonical_events(spark, sf), ["region", "device_category"])


@register("sales_per_search")
def _m23(spark, sf):
    return M.sales_per_search(impute.sales_groups(fx.sales(spark, sf)),
                              fx.canonical_events(spark, sf)).drop("null_sales_count", "rows")


@register("engagement_mom")
def _m24(spark, sf):
    return M.engagement_mom(fx.monthly_events(spark, sf))


@register("searches_mom")
def _m27(spark, sf):
    return M.searches_mom(fx.monthly_events(spark, sf))


@register("kpi_bands")
def _m31(spark, sf):
    return M.measures(fx.canonical_events(spark, sf), ["region"],
                      ["engagement_rate", "engagement_rate_color", "zero_result_rate", "zero_result_rate_color"])


@register("search_success_rate")
def _m33(spark, sf):
    return M.measures(fx.canonical_events(spark, sf), ["device_category"],
                      ["sessions_with_clicks", "search_sessions", "search_success_rate"])


@register("multi_search_sessions")
def _m35(spark, sf):
    return M.multi_search_sessions(fx.canonical_events(spark, sf), ["event_date"])


@register("mart_executive")
def _m36(spark, sf):
    return marts.executive_mart(fx.canonical_events(spark, sf), fx.orders(spark, sf))


@register("mart_behavior")
def _m37(spark, sf):
    return marts.behavior_mart(fx.canonical_events(spark, sf), _zero(spark, sf))["click_distribution"]


@register("mart_behavior_zero_rate")
def _m37_rate(spark, sf):
    return marts.behavior_mart(fx.canonical_events(spark, sf), _zero(spark, sf))["zero_result_rate"]


@register("mart_behavior_top_terms")
def _m37_terms(spark, sf):
    return marts.behavior_mart(fx.canonical_events(spark, sf), _zero(spark, sf))["top_zero_result_terms"]


@register("mom_by_region")
def _mom_region(spark, sf):
    ev = fx.monthly_events(spark, sf)
    return M.engagement_mom(ev, ["region"]).join(
        M.searches_mom(ev, ["region"]), ["region", "month"])


@register("conversion_by_device")
def _conversion_device(spark, sf):
    return M.search_conversion_rate(fx.canonical_events(spark, sf), fx.orders(spark, sf), ["device_category"])


@register("dq_clean")
def _dq_clean(spark, sf):
    """The three checks on curated rows, which pass them."""
    flat = etl.flatten_event_params(_etl_day(spark, sf, dups=True))
    clean = etl.dedupe_events(flat)
    checks = [quality.dq_duplicates(clean), quality.dq_record_count(clean, clean), quality.dq_nulls(clean)]
    return checks[0].select("check_name", "status").unionByName(checks[1].select("check_name", "status")).unionByName(
        checks[2].select("check_name", "status"))


@register("mart_regional")
def _m38(spark, sf):
    return marts.regional_mart(fx.canonical_events(spark, sf), fx.sales(spark, sf))


# ---------------------------------------------------------------- Z2, Z3

@register("detect_typos")
def _z2(spark, sf):
    ev = fx.canonical_events(spark, sf)
    return typos.detect_typos(Z.load_zero_result_searches(ev, REPORT_START, REPORT_END),
                              Z.successful_searches(ev, REPORT_START, REPORT_END))


@register("detect_typos_incremental")
def _z2_index(spark, sf):
    """The same suggestions after three nights, each of which compares its new terms only."""
    columns = ["event_date", "event_name", "event_category", "search_result_count", *Z.ZERO_COLUMNS]
    ev = typos.materialize(fx.canonical_events(spark, sf).select(*dict.fromkeys(columns)), "searches")  # the nights read it six times
    index = TypoIndex(spark, shared_path(spark, "typo-index"))
    cuts = [REPORT_START, REPORT_START + _dt.timedelta(days=12), REPORT_START + _dt.timedelta(days=18), REPORT_END + _dt.timedelta(days=1)]
    for night, (first, after) in enumerate(zip(cuts, cuts[1:])):
        last = after - _dt.timedelta(days=1)
        index.add_night(night, Z.load_zero_result_searches(ev, first, last), Z.successful_searches(ev, first, last))
    return index.suggestions()


@register("detect_typos_levenshtein")
def _z3(spark, sf):
    ev = fx.canonical_events(spark, sf)
    return typos.detect_typos_levenshtein(Z.load_zero_result_searches(ev, REPORT_START, REPORT_END),
                                          Z.successful_searches(ev, REPORT_START, REPORT_END))
