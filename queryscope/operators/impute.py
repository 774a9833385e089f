"""NULL-sales imputation with regional-product means.

Means are computed by a partial/final aggregation (skew-safe: a hot
(region, product) group is combined map-side) and attached by an equi-join
on the group key.  The join side has one row per group; AQE broadcasts it
only when its runtime size is under the broadcast threshold, otherwise a
shuffled join is used and a skewed sales partition is split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.functions.exprs import money_avg

KEYS = ["region", "product_id"]


def regional_product_avg(sales: DataFrame) -> DataFrame:
    """Mean of non-NULL sales per (region, product), sample size, null count.

    ``null_count`` is always 0: NULL sales are removed before grouping
    (kept for schema parity with the reference).  The mean is the exact
    DECIMAL total divided by the count.
    """
    g = sales.filter(F.col("sales_value").isNotNull()).groupBy(*KEYS).agg(
        F.sum("sales_value").alias("_total"),
        F.count(F.lit(1)).alias("sample_size"),
        F.count(F.when(F.col("sales_value").isNull(), 1)).alias("null_count"),
    )
    return g.select(*KEYS, money_avg("_total", "sample_size").alias("avg_sales"),
                    "sample_size", "null_count")


def impute_sales(sales: DataFrame, means: DataFrame | None = None,
                 keep_original: bool = False, ordered: bool = False) -> DataFrame:
    """Fill NULL sales with the group mean and flag the row.

    A LEFT JOIN on (region, product): NULL keys never match and a group
    without any non-NULL sale has no mean, so such rows stay NULL while
    still flagged ``is_imputed = 1`` (as in the reference).
    """
    means = means if means is not None else regional_product_avg(sales)
    m = means.select(*[F.col(k).alias(f"_m_{k}") for k in KEYS],
                     F.col("avg_sales").alias("regional_product_avg"),
                     F.col("sample_size").alias("regional_sample_size"))
    cond = (F.col("region") == F.col("_m_region")) & (F.col("product_id") == F.col("_m_product_id"))
    j = sales.join(m, cond, "left")
    cols = [
        "order_id", "order_date", "region", "product_id", "product_name", "search_term",
        F.coalesce(F.col("sales_value").cast("double"), F.col("regional_product_avg")).alias("sales_value"),
        F.when(F.col("sales_value").isNull(), 1).otherwise(0).alias("is_imputed"),
        "regional_product_avg", "regional_sample_size",
    ]
    if keep_original:
        cols.append(F.col("sales_value").alias("original_sales_value"))
    out = j.select(*cols)
    if ordered:
        out = out.orderBy(F.col("order_date").desc(), "region", "product_id")
    return out


def regional_sales_clean(sales: DataFrame) -> DataFrame:
    """I3 (dashboard): NULL -> mean of its (region, product) over all rows.

    Unlike I2, BLANK keys form a group of their own, so the join is
    null-safe (``<=>``), which Spark still plans as a hash/sort-merge equi-join.
    """
    means = regional_product_avg(sales).select(
        *[F.col(k).alias(f"_m_{k}") for k in KEYS], F.col("avg_sales").alias("_mean"))
    cond = (F.col("region").eqNullSafe(F.col("_m_region"))
            & F.col("product_id").eqNullSafe(F.col("_m_product_id")))
    j = sales.join(means, cond, "left")
    return j.select(
        "order_id", "order_date", "region", "product_id",
        F.col("sales_value").cast("double").alias("sales_value"),
        F.coalesce(F.col("sales_value").cast("double"), F.col("_mean")).alias("regional_sales_clean"),
    )


def sales_groups(sales: DataFrame) -> DataFrame:
    """One pass over the sales: rows, NULLs and exact total per (region, product).

    Everything the dashboard needs of cleaned sales follows from these
    groups: a NULL sale is worth its group's mean, so a group is worth its
    total plus NULLs times total over non-NULL rows.
    """
    return sales.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("sales_value").isNull()).alias("null_sales_count"),
        F.sum("sales_value").alias("total"),
    )


def cleaned_totals(groups: DataFrame, dims: list[str]) -> DataFrame:
    """Per ``dims`` (of region, product): ``total`` of the cleaned sales as
    DECIMAL(38,6), and the counts of rows and NULLs.

    The imputed part of a group is rounded to 10^-6 once; sums are of
    decimals, so they do not depend on the order of rows.
    """
    known = F.col("rows") - F.col("null_sales_count")
    mean = F.try_divide(F.col("total").cast("double"), known.cast("double"))
    imputed = F.coalesce((mean * F.col("null_sales_count")).cast("decimal(28,6)"), F.lit(0).cast("decimal(28,6)"))
    value = F.when(known > 0, F.col("total").cast("decimal(28,6)") + imputed).cast("decimal(28,6)")
    return groups.withColumn("_value", value).groupBy(*dims).agg(
        F.sum("_value").alias("total"), F.sum("rows").alias("rows"), F.sum("null_sales_count").alias("null_sales_count"))


def total_sales_cleaned(groups: DataFrame, dims: list[str]) -> DataFrame:
    """I4: SUMX of the cleaned value by region or product, rounded to cents."""
    return cleaned_totals(groups, dims).select(*dims, F.round("total", 2).cast("double").alias("total_sales_cleaned"))
