"""Parquet table access for the driver-generated data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; column pruning / pushdown happen in the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
