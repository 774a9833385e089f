"""Dashboard measures re-aimed as grouped Spark aggregates.

A DAX measure is evaluated in a filter context; here the context is
``df.filter(...)`` plus grouping dimensions.  ``measures(df, dims, names)``
expands the requested measures into their base aggregates and evaluates
them in ONE ``groupBy(*dims).agg(...)``, then applies the row-wise
formulas.  Non-additive measures (rates, distinct counts, averages) are
always recomputed per grouping, never summed from finer groups.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queryscope.functions import vocab as V
from queryscope.functions.exprs import pct_text, ratio0, safe_ratio
from queryscope.operators import impute

def _name() -> Column:
    return F.col("event_name")


def _submit() -> Column:
    return _name() == V.SUBMIT


def _click() -> Column:
    return _name() == V.CLICK


def _zero(blank_as_zero: bool) -> Column:
    cnt = F.col("search_result_count")
    return _submit() & ((F.coalesce(cnt, F.lit(0)) if blank_as_zero else cnt) == 0)


# name -> builder(blank_as_zero) of a base aggregate Column
BASE: dict[str, Callable[[bool], Column]] = {
    "total_searches": lambda b: F.count_if(_submit()),                                   # M1
    "total_clicks": lambda b: F.count_if(_click()),                                      # M2
    "unique_search_users": lambda b: F.count_distinct(F.when(_submit(), F.col("user_pseudo_id"))),  # M5
    "_results_sum": lambda b: F.sum(F.when(_submit(), F.col("search_result_count"))),
    "_results_n": lambda b: F.count(F.when(_submit(), F.col("search_result_count"))),
    "total_refinements": lambda b: F.count_if(_name() == V.REFINEMENT),                  # M7
    "zero_result_searches": lambda b: F.count_if(_zero(b)),                             # M10
    "unique_zero_result_terms": lambda b: F.count_distinct(F.when(_zero(b), F.col("search_term"))),  # M13
    "_top3_clicks": lambda b: F.count_if(_click() & F.col("click_position").isin(1, 2, 3)),
    "_pos_sum": lambda b: F.sum(F.when(_click(), F.col("click_position"))),
    "_pos_n": lambda b: F.count(F.when(_click(), F.col("click_position"))),
    "sessions_with_clicks": lambda b: F.count_distinct(F.when(_click(), F.col("session_id"))),
    "search_sessions": lambda b: F.count_distinct(F.when(_submit(), F.col("session_id"))),
}

# name -> (base dependencies, formula over the aggregated row)
DERIVED: dict[str, tuple[list[str], Callable[[], Column]]] = {
    "engagement_rate": (["total_clicks", "total_searches"],                            # M3
                        lambda: ratio0("total_clicks", "total_searches")),
    "engagement_rate_pct": (["total_clicks", "total_searches"],                        # M4
                            lambda: pct_text("total_clicks", "total_searches", 1)),
    "avg_results_returned": (["_results_sum", "_results_n"],                           # M6
                             lambda: safe_ratio("_results_sum", "_results_n")),
    "refinement_rate": (["total_refinements", "total_searches"],                       # M8
                        lambda: ratio0("total_refinements", "total_searches")),
    "refinement_rate_pct": (["total_refinements", "total_searches"],                   # M9
                            lambda: pct_text("total_refinements", "total_searches", 1)),
    "zero_result_rate": (["zero_result_searches", "total_searches"],                   # M11
                         lambda: ratio0("zero_result_searches", "total_searches")),
    "zero_result_rate_pct": (["zero_result_searches", "total_searches"],               # M12
                             lambda: pct_text("zero_result_searches", "total_searches", 1)),
    "top3_click_rate": (["_top3_clicks", "total_clicks"],                              # M19
                        lambda: ratio0("_top3_clicks", "total_clicks")),
    "engagement_rate_color": (["total_clicks", "total_searches"],                      # M31
                              lambda: engagement_color(ratio0("total_clicks", "total_searches"))),
    "zero_result_rate_color": (["zero_result_searches", "total_searches"],             # M32
                               lambda: zero_rate_color(ratio0("zero_result_searches", "total_searches"))),
    "search_success_rate": (["sessions_with_clicks", "search_sessions"],               # M33
                            lambda: ratio0("sessions_with_clicks", "search_sessions")),
    "avg_click_position": (["_pos_sum", "_pos_n"],                                     # M34
                           lambda: safe_ratio("_pos_sum", "_pos_n")),
}


def engagement_color(rate: Column) -> Column:
    return (F.when(rate >= V.ENGAGEMENT_GOOD_MIN, V.COLOR_GOOD)
             .when(rate >= V.ENGAGEMENT_OK_MIN, V.COLOR_OK).otherwise(V.COLOR_BAD))


def zero_rate_color(rate: Column) -> Column:
    return (F.when(rate <= V.ZERO_RATE_GOOD_MAX, V.COLOR_GOOD)
             .when(rate <= V.ZERO_RATE_OK_MAX, V.COLOR_OK).otherwise(V.COLOR_BAD))


def measures(df: DataFrame, dims: list[str], names: list[str], blank_as_zero: bool = False) -> DataFrame:
    """Evaluate measures ``names`` per ``dims`` in a single aggregation.

    ``blank_as_zero`` gives the DAX reading of ``[search_result_count] = 0``
    (BLANK equals 0); the default is the SQL reading (NULL is not 0).
    """
    need: list[str] = []
    for n in names:
        for dep in (DERIVED[n][0] if n in DERIVED else [n]):
            if dep not in need:
                need.append(dep)
    g = df.groupBy(*dims).agg(*[BASE[n](blank_as_zero).alias(n) for n in need])
    out = [F.col(n) if n in BASE else DERIVED[n][1]().alias(n) for n in names]
    return g.select(*dims, *out)


# ------------------------------------------------------------ M14–M17 (two tables)

def searched_users(events: DataFrame) -> DataFrame:
    """Distinct users with a 'global search' event (NULL user ignored)."""
    return (events.filter((F.col("event_category") == V.SEARCH_CATEGORY) & F.col("user_pseudo_id").isNotNull())
                  .select("user_pseudo_id").distinct())


def converted_users(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct ordering users that are in M14 (a left-semi join)."""
    return (orders.select("user_pseudo_id").filter(F.col("user_pseudo_id").isNotNull()).distinct()
                  .join(searched_users(events), "user_pseudo_id", "left_semi"))


def search_conversion_rate(events: DataFrame, orders: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """Converted ÷ searched users per ``dims`` of the events.

    As written in the measure, the denominator counts 'global search' users
    while the numerator keeps ordering users that appear in ANY event of the
    context.  Both sides are distinct (dims, user) sets, so the join on
    user cannot fan out.
    """
    dims = dims or []
    ev = events.filter(F.col("user_pseudo_id").isNotNull())
    per_user = ev.groupBy(*dims, "user_pseudo_id").agg(
        F.max(F.col("event_category") == V.SEARCH_CATEGORY).alias("_searched"))
    buyers = orders.select(F.col("user_pseudo_id").alias("_buyer")).filter(F.col("_buyer").isNotNull()).distinct()
    j = per_user.join(buyers, F.col("user_pseudo_id") == F.col("_buyer"), "left")
    g = j.groupBy(*dims).agg(
        F.count_if("_searched").alias("searched_users"),
        F.count("_buyer").alias("converted_users"),
    )
    return g.select(*dims, "searched_users", "converted_users",
                    ratio0("converted_users", "searched_users").alias("search_conversion_rate"),
                    pct_text("converted_users", "searched_users", 1).alias("search_conversion_pct"))


# ------------------------------------------------------------ M18, M22, M23

def clicks_at_position(events: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """Click rows per ``dims`` and click_position (the NULL position is a row)."""
    return measures(events.filter(_click()), [*(dims or []), "click_position"], ["total_clicks"]) \
        .withColumnRenamed("total_clicks", "clicks_at_position")


def regional_search_volume(events: DataFrame, dims: list[str]) -> DataFrame:
    """Searches per ``dims`` next to the region total (ALLEXCEPT region).

    The total is its own small aggregate, joined back by region; where the
    region is not among ``dims`` there is no region in the context and the
    total is that of all rows.
    """
    g = measures(events, dims, ["total_searches"])
    if "region" not in dims:
        return g.withColumn("regional_search_volume", measures(events, [], ["total_searches"]).scalar())
    total = measures(events, ["region"], ["total_searches"]).select(
        F.col("region").alias("_region"), F.col("total_searches").alias("regional_search_volume"))
    return g.join(total, F.col("region").eqNullSafe(F.col("_region"))).drop("_region")


def sales_per_search(groups: DataFrame, events: DataFrame) -> DataFrame:
    """Total Sales Cleaned ÷ Regional Search Volume per region (full outer on region).

    ``groups``: ``impute.sales_groups`` of the sales.
    """
    s = impute.cleaned_totals(groups, ["region"])
    v = measures(events, ["region"], ["total_searches"]).withColumnRenamed("region", "_vregion")
    j = s.join(v, s["region"].eqNullSafe(v["_vregion"]), "full")
    return j.select(
        F.coalesce("region", "_vregion").alias("region"),
        F.round("total", 2).cast("double").alias("total_sales_cleaned"),
        F.col("total_searches").alias("regional_search_volume"),
        F.round(ratio0(F.col("total").cast("double"), "total_searches"), 6).alias("sales_per_search"),
        "null_sales_count", "rows",
    )


# ------------------------------------------------------------ M24–M27 (time intelligence)

def monthly_base(events: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """For each value of ``dims`` every month between its first and last
    event, with BLANK-aware monthly searches and clicks."""
    dims = dims or []
    month = F.trunc("event_date", "month")
    agg = events.groupBy(*dims, month.alias("month")).agg(
        F.nullif(F.count_if(_submit()), F.lit(0).cast("bigint")).alias("total_searches"),
        F.nullif(F.count_if(_click()), F.lit(0).cast("bigint")).alias("total_clicks"),
    )
    cal = agg.groupBy(*dims).agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(
        *dims, F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    return _same(cal, agg, [*dims, "month"], ["total_searches", "total_clicks"])


def _same(left: DataFrame, right: DataFrame, keys: list[str], cols: list[str]) -> DataFrame:
    """Null-safe left join that adds ``cols``."""
    r = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *cols)
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return left.join(r, on, "left").drop(*[f"_{k}" for k in keys])


def _with_previous(m: DataFrame, cols: list[str], dims: list[str]) -> DataFrame:
    prev = m.select(*dims, F.add_months("month", 1).alias("month"), *[F.col(c).alias(f"prev_{c}") for c in cols])
    return _same(m, prev, [*dims, "month"], [f"prev_{c}" for c in cols])


def engagement_mom(events: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """M24–M26 per ``dims``: monthly engagement rate, previous month's, change and change %."""
    dims = dims or []
    m = monthly_base(events, dims).withColumn("engagement_rate", ratio0("total_clicks", "total_searches"))
    j = _with_previous(m, ["engagement_rate"], dims)
    prev = F.coalesce(F.col("prev_engagement_rate"), F.lit(0.0))
    change = F.col("engagement_rate") - prev
    return j.select(*dims, "month", "engagement_rate", prev.alias("engagement_rate_previous"),
                    change.alias("engagement_rate_change"),
                    ratio0(change, prev).alias("engagement_rate_change_pct")).orderBy(*dims, "month")


def searches_mom(events: DataFrame, dims: list[str] | None = None) -> DataFrame:
    """M27 per ``dims``: month-over-month growth of searches (BLANK months count as 0)."""
    dims = dims or []
    j = _with_previous(monthly_base(events, dims), ["total_searches"], dims)
    cur = F.coalesce(F.col("total_searches"), F.lit(0))
    prev = F.coalesce(F.col("prev_total_searches"), F.lit(0))
    return j.select(*dims, "month", "total_searches",
                    F.col("prev_total_searches").alias("previous_total_searches"),
                    ratio0(cur - prev, F.col("prev_total_searches")).alias("mom_growth")).orderBy(*dims, "month")


# ------------------------------------------------------------ M35

def multi_search_sessions(events: DataFrame, dims: list[str]) -> DataFrame:
    """Sessions with more than one submit, per ``dims`` (BLANK session is a value)."""
    per_session = events.groupBy(*dims, "session_id").agg(F.count_if(_submit()).alias("_n"))
    return per_session.filter(F.col("_n") > 1).groupBy(*dims).agg(
        F.count(F.lit(1)).alias("multi_search_sessions"))


# ------------------------------------------------------------ D5–D7 / M28–M30

def data_quality_status(null_pct: Column) -> Column:
    return (F.when(null_pct == 0, V.DQ_COMPLETE).when(null_pct <= V.DQ_MINOR_MAX, V.DQ_MINOR)
             .when(null_pct <= V.DQ_MODERATE_MAX, V.DQ_MODERATE).otherwise(V.DQ_MAJOR))


def sales_quality(sales: DataFrame, dims: list[str]) -> DataFrame:
    """NULL sales count, NULL share and the four-level status per ``dims``."""
    g = sales.groupBy(*dims).agg(
        F.count_if(F.col("sales_value").isNull()).alias("null_sales_count"),
        F.count(F.lit(1)).alias("_rows"),
    )
    pct = ratio0("null_sales_count", "_rows")
    return g.select(*dims, "null_sales_count", pct.alias("null_sales_pct"),
                    data_quality_status(pct).alias("data_quality_status"))
