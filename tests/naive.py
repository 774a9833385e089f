"""A naive form of the attribution, for comparison."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.operators.etl import ATTRIBUTION_KEYS, ORDER_COLUMNS


def naive_attribution(fact: DataFrame, orders: DataFrame) -> DataFrame:
    """Every event meets every order of its user; orders out of reach are blanked, then rows are grouped."""
    o = orders.select(F.col("user_pseudo_id").alias("buyer"), *ORDER_COLUMNS)
    gap = F.datediff("order_date", "event_date")
    paired = fact.withColumn("row", F.monotonically_increasing_id()).join(o, F.col("user_pseudo_id") == F.col("buyer"), "left")
    paired = paired.withColumn("near", F.coalesce(gap.between(0, 30), F.lit(False)))
    some = paired.groupBy("row").agg(F.max("near").alias("any"))
    kept = paired.join(some, "row").filter(F.col("near") | ~F.col("any"))
    blank = kept.select(*[c for c in kept.columns if c not in ORDER_COLUMNS],
                        *[F.when(F.col("near"), F.col(c)).alias(c) for c in ORDER_COLUMNS])
    out = blank.groupBy(*ATTRIBUTION_KEYS, *ORDER_COLUMNS).agg(
        F.size(F.collect_set("event_timestamp")).cast("bigint").alias("search_count"),
        F.max((F.col("event_name") == "global_search_click_result").cast("int")).alias("clicked_result"),
        F.max("is_zero_result").alias("had_zero_result"))
    return out.withColumn("days_to_conversion", F.datediff("order_date", "event_date"))
