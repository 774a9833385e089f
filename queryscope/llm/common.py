"""Helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queryscope.session import shared_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; an argument of every operator that takes one."""
    import public_tokenizers
    return public_tokenizers.path(name)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` set to ``value`` while a job runs."""
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old)


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows while a job runs: whole texts are long rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = int(spark.conf.get(key))
    with setting(spark, key, str(min(rows, old) if old > 0 else rows)):
        yield


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the cluster's shared folder and read back.

    Cuts the lineage: what follows restarts from the files when an executor
    is lost, and a table that is read several times is computed once.  The
    shuffle files of the job go as soon as the table is written.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    with small_batches(spark), setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def forget(*frames: DataFrame) -> None:
    """Remove tables made by ``stored`` that nothing will read any more."""
    for df in frames:
        path = df._stored_at
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ids_and_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id (long) and text (null: empty).

    A long id is taken as it is: behind an alias, two uses of the texts in
    one plan would not share their shuffle.
    """
    id_ = F.col("doc_id") if dict(df.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id")
    return df.select(id_, text_or_empty(text).alias("text"))


def per_text(texts: pa.Array, max_bytes: int) -> Iterator[list[str]]:
    """The texts of an Arrow column in runs of at most ``max_bytes`` (one text at least)."""
    run: list[str] = []
    size = 0
    for t in texts:
        s = t.as_py() or ""
        if run and size + len(s) > max_bytes:
            yield run
            run, size = [], 0
        run.append(s)
        size += len(s)
    if run:
        yield run


def append_columns(df: DataFrame, col: str, fields: str, make: Callable[[], Callable[[list[str]], list[pa.Array]]],
                   max_bytes: int = 4 << 20) -> DataFrame:
    """``df`` with columns computed from one text column in Arrow batches.

    ``make()`` runs once in each task and returns a function from a list of
    texts to the new columns' Arrow arrays.  Batches are cut by text size,
    so memory is bounded by ``max_bytes`` and the longest single text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    extra = _parse_datatype_string(fields)
    names = [f.name for f in extra.fields]
    clash = [c for c in df.columns if c in names]
    kept = df.drop(*clash) if clash else df
    schema = StructType(kept.schema.fields + extra.fields)
    arrow = to_arrow_schema(schema)
    src = kept.columns.index(col)

    def run(batches):
        fn = make()
        for batch in batches:
            at = 0
            for texts in per_text(batch.column(src), max_bytes):
                part = batch.slice(at, len(texts))
                at += len(texts)
                cols = [c.cast(arrow.field(i).type) for i, c in enumerate(part.columns)] + fn(texts)
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return kept.mapInArrow(run, schema)


def spans(lengths) -> pa.Array:
    """List offsets from lengths."""
    import numpy as np
    out = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=out[1:])
    return pa.array(out, pa.int32())


def slices(batches, rows: int = 500):
    """Arrow batches cut into parts of at most ``rows`` rows, for steps that hold a part as Python objects."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def buckets_for(df: DataFrame, least: int, bytes_each: int = 4 << 20, most: int = 1 << 15) -> int:
    """How many buckets to deal the texts of ``df`` to: by the size the planner knows of its files, so that a bucket stays small."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, partitions, min(most, size // bytes_each))
