"""Exact distinct counts that roll up: a dense id dictionary and daily bitmaps (§2.9; M5, M13, M33, B7).

A COUNT(DISTINCT user) of one day cannot be added to another day's.  Here each
value gets a number from 1 on, once and for all; a day keeps one bitmap per
group and 32,768 numbers.  Any range of days is the OR of its bitmaps and
their bit count, exact, without the events.  Numbers are dense, so bitmaps
are full and there are few of them; a night reads its own day only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.operators.typos import materialize

_ROW_BITS = 33  # of monotonically_increasing_id: partition above, row below


def numbered(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(value, id) for all values: those of ``known`` keep their id, new ones are numbered on, without gaps.

    ``values`` has one column; nulls have no number.  Rows are counted within
    their partition; the driver adds up one count per partition.
    """
    col = values.columns[0]
    new = values.select(F.col(col).alias("value")).filter(F.col("value").isNotNull()).distinct()
    base = 0
    if known is not None:
        new = new.join(known, "value", "left_anti")
        base = known.agg(F.max("id").alias("n")).first().n or 0
    rows = materialize(new.withColumn("m", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("m", _ROW_BITS)
    counts = sorted((r.part, r.n) for r in rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts = []
    for p, n in counts:
        starts.append((p, base))
        base += n
    offsets = values.sparkSession.createDataFrame(starts, "part long, first long")
    fresh = rows.withColumn("part", part).join(F.broadcast(offsets), "part").select(  # a row per partition of the job before
        "value", (F.col("first") + F.col("m").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1).alias("id"))
    return fresh if known is None else known.select("value", "id").unionByName(fresh)


def daily_bitmaps(events: DataFrame, dictionary: DataFrame, value: str, day: str, dims: list[str] | None = None) -> DataFrame:
    """(dims, day, bucket, bits): the numbers of each day's values."""
    keys = [*(dims or []), day]
    seen = events.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("value")).distinct()
    ids = seen.join(dictionary, "value")
    return ids.groupBy(*keys, F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def distinct_in_trailing_days(bitmaps: DataFrame, day: str, windows: list[int], dims: list[str] | None = None) -> DataFrame:
    """(window_days, end_date, dims, n): exact distinct values of the last ``window_days`` days up to each day there is."""
    keys = ["window_days", "end_date", *(dims or [])]
    def ends_of(w: int):
        return F.transform(F.sequence(F.lit(0), F.lit(w - 1)), lambda i: F.struct(
            F.lit(w).alias("window_days"), F.date_add(F.col(day), i).alias("end_date")))

    reach = F.flatten(F.array(*[ends_of(w) for w in windows]))
    ends = bitmaps.select(F.col(day).alias("end_date")).distinct()
    per_bucket = (bitmaps.withColumn("r", F.explode(reach)).select("r.*", *(dims or []), "bucket", "bits")
                  .join(ends, "end_date", "left_semi").groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits")))
    return per_bucket.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def distinct_between(bitmaps: DataFrame, day: str, start, end, dims: list[str] | None = None) -> DataFrame:
    """(dims, n): exact distinct values from ``start`` to ``end``."""
    some = bitmaps.filter(F.col(day).between(start, end)).groupBy(*(dims or []), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return some.groupBy(*(dims or [])).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))
