"""Deterministic projections of the driver tables onto the reference's inputs.

The driver tables carry no clickstream columns, so ``search_events``,
``orders`` and ``sales`` are derived from ``events``/``part``/TPC-H tables
by fixed rules (documented in FIXTURES.md).  The SQL oracle derives the same
inputs with the same rules in DuckDB.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryscope.functions import vocab as V
from queryscope.functions.exprs import click_position_of, epoch_micros, region_of
from queryscope.sources.tables import read_table

# --- fixed values: fixture derivation rules ---------------------------------
MODEL_NUMBER_EVERY = 16          # one part in 16 is searched with its number, so terms grow with part
LABEL_SUFFIXES = [*(kind for kind, _ in V.SEARCH_TYPE_SUFFIXES), "voice"]
COUNTRIES = [*(code for _, codes in V.REGION_COUNTRIES for code in codes), "BR", "AU", ""]
DEVICES = ["desktop", "mobile", "tablet"]
SOURCES = ["google", "direct", "email", "(none)"]
BUYER_STEP = 3                   # customer c orders as user 3c: two users in three never buy
SALES_REGIONS = {"AMERICA": "North America", "EUROPE": "Europe", "ASIA": "Asia", "AFRICA": "Other", "MIDDLE EAST": "Other"}
ORDER_EPOCH = _dt.date(2024, 1, 1)
MONTHLY_EPOCH = _dt.date(2023, 10, 1)

SEARCH_EVENT_COLUMNS = [
    "event_date", "event_timestamp", "event_name", "user_pseudo_id",
    "event_category", "event_label", "search_term", "search_result_count",
    "page_name", "session_id", "country_code", "device_category", "traffic_source",
]


def _pick(values: list[str], idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx.cast("int"))


def search_events(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """Flat GA4-style events (``ga4_events``) without the derived columns."""
    ev = read_table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
    )
    # keys of part run from 0: every part is searched, an ordinary join over both tables
    part = read_table(spark, sf_dir, "part").select("p_partkey", F.when(
        F.col("p_partkey") % MODEL_NUMBER_EVERY == 0, F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string")))
        .otherwise(F.col("p_name")).alias("p_name"))
    parts = read_table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    e = ev.withColumn("part_key", F.col("event_id") % parts).join(part, F.col("p_partkey") == F.col("part_key"))

    k, et, p = F.col("k"), F.col("event_type"), F.col("p_name")
    uid = F.col("user_id").cast("string")
    day = F.to_date("ts")
    name = (F.when(et == "view", V.SUBMIT).when(et == "signup", V.SUBMIT)
            .when(et == "click", V.CLICK).when(et == "error", V.REFINEMENT)
            .otherwise(V.PAGE_VIEW))
    label = F.when(
        et == "click",
        F.when(k % 25 == 3, F.lit("results")).otherwise(
            F.concat(F.lit("results|"), (1 + k % 10).cast("string"), F.lit("|/p/"),
                     (F.col("event_id") % 20).cast("string"))),
    ).otherwise(F.concat(F.lit("search|"), _pick(LABEL_SUFFIXES, 1 + k % 4)))
    term = (F.when(k == 99, F.lit(None).cast("string"))
            .when(k % 10 == 0, F.concat(F.substring(p, 1, 3), F.substring(p, 5, 1 << 30)))
            .when(k % 10 == 1, F.concat(F.lit(" "), F.upper(p)))
            .when(k % 10 == 2, F.concat(p, F.lit(" price")))
            .when(k % 10 == 3, F.concat(p, F.lit(" vs ring")))
            .when(k % 10 == 4, F.split_part(p, F.lit(" "), F.lit(1)))
            .when(k % 10 == 5, F.concat(p, F.lit(" battery")))
            .otherwise(p))
    count = (F.when(k % 20 == 7, F.lit(None).cast("int"))
             .when((k % 10 == 0) | (k % 20).isin(1, 12, 13, 14, 15), F.lit(0))
             .otherwise(k)).cast("int")
    page = (F.when(et != "purchase", F.lit(None).cast("string"))
            .when(k % 3 == 0, F.lit("home")).otherwise(F.lit(V.RESULT_PAGE)))
    session = F.concat(F.lit("u"), uid, F.lit("-"), day.cast("string"),
                       F.when(F.hour("ts") < 12, F.lit("-am")).otherwise(F.lit("-pm")))
    cols = [
        day.alias("event_date"),
        epoch_micros("ts").alias("event_timestamp"),
        name.alias("event_name"),
        F.when(k == 98, F.lit(None).cast("string")).otherwise(F.concat(F.lit("u"), uid)).alias("user_pseudo_id"),
        F.when(k % 13 == 0, F.lit("navigation")).otherwise(F.lit(V.SEARCH_CATEGORY)).alias("event_category"),
        label.alias("event_label"),
        term.alias("search_term"),
        count.alias("search_result_count"),
        page.alias("page_name"),
        session.alias("session_id"),
        F.nullif(_pick(COUNTRIES, 1 + F.col("user_id") % 14), F.lit("")).alias("country_code"),
        _pick(DEVICES, 1 + k % 3).alias("device_category"),
        _pick(SOURCES, 1 + F.col("user_id") % 4).alias("traffic_source"),
    ]
    if with_id:
        cols = [F.col("event_id")] + cols
    return e.select(*cols)


def with_derived(df: DataFrame) -> DataFrame:
    """Canonical ``SearchEvents``: add click_position (B3b) and region (B3d)."""
    return df.withColumn("click_position", click_position_of("event_label")) \
             .withColumn("region", region_of("country_code"))


def canonical_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_derived(search_events(spark, sf_dir))


def events_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat events plus an exact second copy of every row with event_id % 50 = 0."""
    e = search_events(spark, sf_dir, with_id=True)
    return e.unionByName(e.filter(F.col("event_id") % 50 == 0)).drop("event_id")


def monthly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events spread over 2023-10 … 2024-02 for month-over-month."""
    e = with_derived(search_events(spark, sf_dir, with_id=True))
    return e.withColumn(
        "event_date", F.date_add(F.lit(MONTHLY_EPOCH), (F.col("event_id") * 37 % 150).cast("int"))
    ).drop("event_id")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the driver table, mapped onto the reference's order schema."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.concat(F.lit("u"), (F.col("o_custkey") * BUYER_STEP).cast("string")).alias("user_pseudo_id"),
        F.date_add(F.lit(ORDER_EPOCH), (F.col("o_orderkey") * 7 % 45).cast("int")).alias("order_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("order_value"),
        (F.col("o_orderkey") % 200).alias("product_id"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales_data``: one row per line item with region and a nullable value."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation (25 rows) and region (5 rows) have a fixed size at every TPC-H
    # scale factor, so their join is a proven-small broadcast.
    geo = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").join(
        read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"),
        F.col("n_regionkey") == F.col("r_regionkey"))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = (li.join(o, F.col("o_orderkey") == F.col("l_orderkey"))
           .join(c, F.col("c_custkey") == F.col("o_custkey"))
           .join(F.broadcast(geo), F.col("n_nationkey") == F.col("c_nationkey"))
           .join(p, F.col("p_partkey") == F.col("l_partkey")))
    region = F.create_map(*[F.lit(x) for pair in SALES_REGIONS.items() for x in pair])[F.col("r_name")]
    missing = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 20 < 3) | (F.col("l_partkey") % 97 == 0)
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.when(F.col("c_custkey") % 101 == 0, F.lit(None).cast("string")).otherwise(region).alias("region"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_name").alias("search_term"),
        F.when(missing, F.lit(None)).otherwise(F.col("l_extendedprice")).cast("decimal(18,2)").alias("sales_value"),
    )


def _param(key: str, string_value=None, int_value=None) -> F.Column:
    sv = (string_value if string_value is not None else F.lit(None)).cast("string")
    iv = (int_value if int_value is not None else F.lit(None)).cast("bigint")
    return F.struct(F.lit(key).alias("key"),
                    F.struct(sv.alias("string_value"), iv.alias("int_value")).alias("value"))


def raw_ga4_events(spark: SparkSession, sf_dir: str, flat: DataFrame | None = None) -> DataFrame:
    """Nested GA4 export rows: params packed into ``event_params``.

    Absent values are left out of the param list (as GA4 does), so the
    flattening operator must turn a missing key into NULL.  ``event_action``
    carries the event name.
    """
    flat = flat if flat is not None else search_events(spark, sf_dir)
    params = F.array(
        _param("event_category", F.col("event_category")),
        _param("event_action", F.col("event_name")),
        _param("event_label", F.col("event_label")),
        _param("search_term", F.col("search_term")),
        _param("search_result_count", int_value=F.col("search_result_count")),
        _param("page_name", F.col("page_name")),
    )
    present = F.filter(params, lambda p: p["value"]["string_value"].isNotNull()
                       | p["value"]["int_value"].isNotNull())
    return flat.select(
        "event_date", "event_timestamp", "event_name", "user_pseudo_id",
        present.alias("event_params"),
        F.struct(F.col("country_code").alias("country")).alias("geo"),
        F.struct(F.col("device_category").alias("category")).alias("device"),
        F.struct(F.col("traffic_source").alias("source")).alias("traffic_source"),
    )
