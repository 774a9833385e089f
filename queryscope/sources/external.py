"""A5: orders from a foreign system, read with its own reader options and checked.

The reference joins a table of another system.  Here it is any source that
Spark reads (files, JDBC, a connector): a spec names the format, its options
and the mapping of foreign columns onto ours.  What arrives is checked
against the schema before anything uses it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDERS_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_pseudo_id", T.StringType()),
    T.StructField("order_date", T.DateType(), False),
    T.StructField("order_value", T.DecimalType(18, 2)),
    T.StructField("product_id", T.LongType()),
])


class SchemaMismatch(ValueError):
    """The source lacks a column, or a value does not fit its type."""


@dataclass
class ExternalSource:
    """``columns`` maps our column to an SQL expression over the foreign ones; ``schema`` is the foreign schema, if the format needs one."""

    format: str
    path: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    columns: dict[str, str] = field(default_factory=dict)
    schema: str | None = None


def jdbc_source(url: str, table: str, columns: dict[str, str], split: str, low: int, high: int, partitions: int, **options: str) -> ExternalSource:
    """A table read over JDBC in ``partitions`` ranges of the numeric column ``split``, not through one connection."""
    ranges = {"partitionColumn": split, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}
    return ExternalSource("jdbc", None, {"url": url, "dbtable": table, **ranges, **options}, columns)


def read_external(spark: SparkSession, source: ExternalSource, wanted: T.StructType = ORDERS_SCHEMA) -> DataFrame:
    """The source's rows in the wanted schema.

    A column that is neither mapped nor there fails before any row is read.
    Where a value is there but cannot be cast, or a required one is missing,
    the job fails with the column's name; no row is dropped or set to null.
    The check is part of the projection, so it takes no pass of its own and
    keeps column pruning and filters on plainly mapped columns.
    """
    reader = spark.read.format(source.format).options(**source.options)
    if source.schema:
        reader = reader.schema(source.schema)
    raw = reader.load(source.path) if source.path else reader.load()
    lacking = [f.name for f in wanted.fields if f.name not in source.columns and f.name not in raw.columns]
    if lacking:
        raise SchemaMismatch(f"{source.format} source lacks {', '.join(lacking)}; it has {', '.join(raw.columns)}")
    return raw.select(*[_checked(F.expr(source.columns.get(f.name, f"`{f.name}`")), f) for f in wanted.fields])


def _checked(value: Column, f: T.StructField) -> Column:
    cast = value.try_cast(f.dataType)
    unfit = F.raise_error(F.concat(F.lit(f"{f.name}: not a {f.dataType.simpleString()}: "), value.cast("string"))).cast(f.dataType)
    out = F.when(value.isNotNull() & cast.isNull(), unfit)
    if not f.nullable:
        out = out.when(value.isNull(), F.raise_error(F.lit(f"{f.name}: missing")).cast(f.dataType))
    return out.otherwise(cast).alias(f.name)
