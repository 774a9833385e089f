"""Daily export shards as a table partitioned by the shard suffix.

A wildcard export ``events_*`` filtered on ``_TABLE_SUFFIX = 'YYYYMMDD'``
maps onto a parquet table partitioned by ``_table_suffix``: the suffix
filter becomes a partition filter, so only that day's folder is listed
and read.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUFFIX = "_table_suffix"


def write_daily_shards(raw: DataFrame, root: str, mode: str = "overwrite") -> None:
    """Land a raw export as one ``_table_suffix=YYYYMMDD`` folder per event day.

    ``append`` adds files to the days (late or repeated exports).
    """
    (raw.withColumn(SUFFIX, F.date_format("event_date", "yyyyMMdd"))
        .write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy(SUFFIX).parquet(root))


def read_daily_shard(spark: SparkSession, root: str, as_of: _dt.date) -> DataFrame:
    """A1: the shard of the day before ``as_of`` (partition-pruned scan)."""
    day = as_of - _dt.timedelta(days=1)
    return (spark.read.parquet(root).filter(F.col(SUFFIX) == F.lit(f"{day:%Y%m%d}"))
                 .drop(SUFFIX))


def shard_path(root: str, day: _dt.date) -> str:
    return f"{root.rstrip('/')}/{SUFFIX}={day:%Y%m%d}"
