"""Sinks: replace-table writes (A7) and CSV export of report frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """CREATE OR REPLACE TABLE … AS — a full overwrite of the target path."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Header row, no index column; written in parallel by the executors
    (one part file per task) instead of through the driver."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_report(frames: dict[str, DataFrame], root: str) -> None:
    """Write every frame of a report bundle to ``{root}/{name}`` as CSV."""
    for name, df in frames.items():
        export_csv(df, f"{root.rstrip('/')}/{name}")


def write_clustered(df: DataFrame, path: str, day: str = "data_date", key: str = "user_pseudo_id", then: str = "event_timestamp",
                    files: int = 200, distinct_keys: int = 100_000, row_group_bytes: int = 32 << 20) -> None:
    """A6 by day, and by user within a day: a query for one user opens few row groups.

    Rows are ranged by (day, user, time), so a user with very many rows is
    dealt over several files.  Sorted files have narrow user statistics per
    row group, and a bloom filter (of ``distinct_keys`` a row group, about)
    rules out the groups whose range holds the user by chance.
    """
    (df.repartitionByRange(files, day, key, then).sortWithinPartitions(day, key, then).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group_bytes)
       .option(f"parquet.bloom.filter.enabled#{key}", "true")
       .option(f"parquet.bloom.filter.expected.ndv#{key}", distinct_keys).partitionBy(day).parquet(path))
