"""Data-quality checks over the curated fact (D1–D3) and imputation.

Every check is one aggregate producing one row; inputs from other
datasets enter as scalar subqueries (each a distributed aggregate to a
single value), never through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryscope.functions import vocab as V
from queryscope.functions.exprs import money_avg, pct2


def _status(ok) -> F.Column:
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))


def dq_duplicates(fact: DataFrame) -> DataFrame:
    """Rows minus distinct (timestamp, user) pairs; NULL-containing pairs are not counted."""
    n = F.count(F.lit(1))
    nd = F.count_distinct("event_timestamp", "user_pseudo_id")
    return fact.agg(
        F.lit("Duplicate Check").alias("check_name"),
        (n - nd).alias("duplicate_count"),
        _status(n == nd).alias("status"),
    )


def dq_record_count(fact: DataFrame, source: DataFrame | int,
                    tolerance: int = V.RECORD_COUNT_TOLERANCE) -> DataFrame:
    """Curated rows vs source rows, PASS when |difference| < tolerance.

    ``source`` is the source DataFrame (counted by a scalar subquery) or a
    count already observed while the source was processed.
    """
    if isinstance(source, int):
        src = F.lit(source).cast("bigint")
    else:
        src = source.select(F.count(F.lit(1))).scalar()
    return record_check(fact.agg(F.count(F.lit(1)).alias("n")), src, tolerance)


def record_check(counts: DataFrame, source: F.Column, tolerance: int = V.RECORD_COUNT_TOLERANCE) -> DataFrame:
    """D2 from a row that holds the number of curated rows (``n``)."""
    return counts.select(
        F.lit("Record Count Check").alias("check_name"),
        F.col("n").alias("curated_records"),
        source.alias("source_records"),
        _status(F.abs(F.col("n") - source) < tolerance).alias("status"),
    )


def null_counts() -> list[F.Column]:
    """Aggregates of D3: rows without a user, without a date, without either."""
    user, date = F.col("user_pseudo_id").isNull(), F.col("event_date").isNull()
    return [F.sum(F.when(missing, 1).otherwise(0)).alias(name)
            for name, missing in (("null_users", user), ("null_dates", date), ("null_rows", user | date))]


def dq_nulls(fact: DataFrame) -> DataFrame:
    """D3: NULL users / dates; an empty input sums to NULL and reports FAIL."""
    return null_check(fact.agg(*null_counts()))


def null_check(counts: DataFrame) -> DataFrame:
    """D3 from a row of ``null_counts``."""
    return counts.select(F.lit("NULL Check").alias("check_name"), "null_users", "null_dates",
                         _status(F.col("null_rows") == 0).alias("status"))


def as_row(spark: SparkSession, counts: dict[str, int | None]) -> DataFrame:
    """Counts that a load job observed, as a row."""
    return spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in counts.items()])


def imputation_summary(groups: DataFrame) -> DataFrame:
    """Per (region, product) with at least one NULL sale: counts, NULL %, mean, sample.

    ``groups``: ``impute.sales_groups`` of the sales.  NULL keys match no
    mean in the enriched table, so their mean and sample are NULL.
    """
    known = F.col("rows") - F.col("null_sales_count")
    matched = F.col("region").isNotNull() & F.col("product_id").isNotNull() & (known > 0)
    return groups.filter(F.col("null_sales_count") > 0).select(
        "region", "product_id", F.col("rows").alias("total_records"), F.col("null_sales_count").alias("null_count"),
        pct2("null_sales_count", "rows").alias("null_percentage"),
        F.when(matched, money_avg("total", known)).alias("avg_sales"),
        F.when(matched, known).alias("min_sample_size"),
    ).orderBy(F.col("null_percentage").desc(), "region", "product_id")
