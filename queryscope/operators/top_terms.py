"""C2/Z1 over any range of days: exact top terms from sorted daily counts, by a uniform threshold in three phases.

1. Each day's first k terms give partial totals; the k-th largest of them is a
   lower bound t of the k-th total.
2. A term with a total of t has t / days or more on some day, so only daily
   counts of at least t / days matter.  They lie in front of each sorted
   file; row groups below are skipped by their statistics.
3. The terms left whose upper bound still reaches the k-th partial total are
   looked up on all days of the range; their totals are exact, and no other
   term can be among the first k.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from queryscope.operators.typos import materialize, remove

DAILY = "search_term string, n long, event_date date"


def store_daily_terms(hits: DataFrame, path: str, files_per_day: int = 1) -> None:
    """Counts per (day, term), the frequent ones first in each file; whole days, which replace what was there."""
    daily = hits.groupBy("event_date", "search_term").agg(F.count(F.lit(1)).alias("n"))
    share = F.pmod(F.xxhash64("search_term"), F.lit(files_per_day))
    (daily.repartition(F.col("event_date"), share).sortWithinPartitions("event_date", F.col("n").desc(), "search_term")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path))


def top_terms(spark: SparkSession, path: str, start: _dt.date, end: _dt.date, k: int) -> tuple[DataFrame, dict[str, int]]:
    """(search_term, zero_result_count, days_occurring) of the k most frequent terms, ties by term (null first), and figures of the search."""
    days = spark.read.schema(DAILY).parquet(path).filter(F.col("event_date").between(F.lit(start), F.lit(end)))
    m = days.select("event_date").distinct().count()
    heads = days.withColumn("r", F.row_number().over(Window.partitionBy("event_date").orderBy(F.col("n").desc(), "search_term"))).filter(F.col("r") <= k)

    def kth(rows: DataFrame) -> int:
        first = rows.groupBy("search_term").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc()).limit(k).agg(F.count(F.lit(1)), F.min("n")).first()
        return int(first[1]) if first[0] == k else 0

    t = kth(heads)
    least = max(1, -(-t // m)) if m else 1
    some = materialize(days.filter(F.col("n") >= least).groupBy("search_term").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("days")), "top-terms")
    bound = kth(some)
    reach = some.filter(F.col("n") + (F.lit(m) - F.col("days")) * (least - 1) >= bound).select(F.col("search_term").alias("c"))
    exact = days.join(reach, F.col("search_term").eqNullSafe(F.col("c")), "left_semi").groupBy("search_term").agg(
        F.sum("n").alias("zero_result_count"), F.count(F.lit(1)).alias("days_occurring"))
    out = materialize(exact.orderBy(F.col("zero_result_count").desc(), F.col("search_term").asc_nulls_first()).limit(k), "top-terms")
    figures = {"days": m, "least_daily_count": least, "terms_read": some.count(), "terms_looked_up": reach.count()}
    remove(some)
    return out, figures
