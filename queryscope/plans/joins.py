"""Join strategies the built-in planner does not pick on its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(width)).cast("bigint")


def range_left_join(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str,
                    lo: int, hi: int, right_key: str | None = None) -> DataFrame:
    """``left LEFT JOIN right ON key = key AND right_day BETWEEN left_day+lo AND left_day+hi``.

    The day range becomes part of the equi-join key: days are cut into
    buckets of ``hi - lo + 1`` days, every left row lands in exactly one
    bucket and every right row is copied into the (at most two) buckets
    whose left days can reach it, so each matching pair meets once and a
    hot key is spread over its time buckets.

    One plan serves every size.  Matches come from an inner join, of which
    AQE may split a skewed partition on either side; rows without a match
    come from an anti join against the distinct (key, day) pairs of the
    right side, which are as few as the days a key occurs on.
    """
    width = hi - lo + 1
    rk = right_key or key
    rd = F.col(right_day)
    buckets = F.array_distinct(F.array(_bucket(F.date_sub(rd, hi), width),
                                       _bucket(F.date_sub(rd, lo), width)))
    helper = ["_lbucket", "_rbucket", "_rkey"]
    lft = left.withColumn("_lbucket", _bucket(F.col(left_day), width))
    reach = lambda df: df.withColumn("_rbucket", F.explode(buckets)).withColumnRenamed(rk, "_rkey")
    cond = ((F.col(key) == F.col("_rkey")) & (F.col("_lbucket") == F.col("_rbucket"))
            & rd.between(F.date_add(F.col(left_day), lo), F.date_add(F.col(left_day), hi)))
    matched = lft.join(reach(right), cond, "inner")
    missed = lft.join(reach(right.select(rk, right_day).distinct()), cond, "left_anti")
    return matched.unionByName(missed, allowMissingColumns=True).drop(*helper)


def range_semi_join(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str, lo: int, hi: int) -> DataFrame:
    """Rows of ``left`` with some row of ``right`` of the same key, lo..hi days after them; keyed by time bucket as above."""
    width = hi - lo + 1
    rd = F.col(right_day)
    buckets = F.array_distinct(F.array(_bucket(F.date_sub(rd, hi), width), _bucket(F.date_sub(rd, lo), width)))
    near = right.select(F.col(key).alias("_rkey"), right_day).withColumn("_rbucket", F.explode(buckets))
    cond = ((F.col(key) == F.col("_rkey")) & (F.col("_lbucket") == F.col("_rbucket"))
            & rd.between(F.date_add(F.col(left_day), lo), F.date_add(F.col(left_day), hi)))
    return left.withColumn("_lbucket", _bucket(F.col(left_day), width)).join(near, cond, "left_semi").drop("_lbucket")
