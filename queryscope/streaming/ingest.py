"""Incremental ingest of landing GA4 shards with Structured Streaming.

The nightly job's "only yesterday's shard" logic becomes a file stream over
the landing folder: the checkpoint (in the cluster's shared folder) records
which files were processed.  A micro-batch says which days changed; each of
these days is curated anew from its landed files (flatten -> dedupe ->
categorize) and its partition replaced.  So a day may arrive in any number of
files, late or exported again, and a replayed batch gives the same partition.
Files landed by suffix (``sources.shards``) are opened only for the days that
changed, so a batch costs what these days hold, however long the history is;
files outside a suffix folder may hold any day and are always opened.
``Trigger.AvailableNow`` gives the daily-batch cadence: process everything
that landed, then stop.
"""

from __future__ import annotations

import datetime as _dt
import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from queryscope.operators import etl
from queryscope.session import shared_path
from queryscope.sources.shards import SUFFIX

RAW_SCHEMA = T.StructType([
    T.StructField("event_date", T.DateType()),
    T.StructField("event_timestamp", T.LongType()),
    T.StructField("event_name", T.StringType()),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("event_params", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StructType([
            T.StructField("string_value", T.StringType()),
            T.StructField("int_value", T.LongType()),
        ])),
    ]))),
    T.StructField("geo", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("device", T.StructType([T.StructField("category", T.StringType())])),
    T.StructField("traffic_source", T.StructType([T.StructField("source", T.StringType())])),
])


def load_batch(batch: DataFrame, landing: str, fact_path: str, processed_at: _dt.datetime) -> None:
    """One micro-batch: rebuild the days it holds from the landing folder."""
    spark = batch.sparkSession
    days = [r["event_date"] for r in batch.select("event_date").distinct().collect()]  # days, not rows
    if not days:
        return
    raw = landed_days(spark, landing, days)
    flat = etl.flatten_event_params(raw)
    cat = etl.categorize_events(etl.dedupe_events(flat), None, processed_at)
    (etl.to_fact(cat, None).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("data_date").parquet(fact_path))


def landed(reader, landing: str) -> DataFrame:
    return reader.schema(RAW_SCHEMA).option("recursiveFileLookup", "true").parquet(landing)


def landed_days(spark: SparkSession, landing: str, days: list[_dt.date]) -> DataFrame:
    """The landed rows of these days; folders of other days are listed, never opened."""
    wanted, places = {f"{day:%Y%m%d}" for day in days}, set()
    for f in landed(spark.read, landing).inputFiles():
        suffix = re.search(rf"/{SUFFIX}=([^/]*)/", f)
        if suffix is None:
            places.add(unquote(f))
        elif suffix[1] in wanted:
            places.add(unquote(f[:suffix.end() - 1]))
    rows = spark.read.schema(RAW_SCHEMA).option("recursiveFileLookup", "true").parquet(*sorted(places))
    return rows.filter(F.col("event_date").isin(days))


def start_incremental_ingest(spark: SparkSession, landing: str, fact_path: str,
                             checkpoint: str | None = None,
                             processed_at: _dt.datetime | None = None,
                             max_files: int | None = None) -> StreamingQuery:
    """Start the AvailableNow stream from ``landing`` (parquet shards) into the fact.

    ``max_files`` caps the files of one micro-batch, not what is loaded.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files) if max_files else spark.readStream

    def each(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, landing, fact_path,
                   processed_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0))

    return (landed(reader, landing).writeStream.foreachBatch(each)
               .option("checkpointLocation", checkpoint or shared_path(spark, "ingest-checkpoint"))
               .trigger(availableNow=True).start())
