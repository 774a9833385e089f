"""Small tables with every awkward case, and the operators' brute-force forms."""

import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(__file__))

from brute import LINE, PASSAGE, words  # noqa: E402

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def awkward_rows():
    base = words(120, 1)
    rows = [
        (0, base, "en", "a"), (1, base, "en", "a"), (2, base.replace("a", "b", 3), "en", "a"),   # a copy, a near copy
        (3, None, "en", "a"), (4, "", None, None), (5, " \n\t ", "en", "b"),                      # nothing to read
        (6, "one two", "en", "b"), (7, "One  TWO", "en", "b"), (8, "one", None, "b"),             # fewer than five words
        (9, words(40, 2) + " " + PASSAGE + " " + words(40, 3), "en", "c"),
        (10, words(30, 4) + " " + PASSAGE + " " + words(60, 5), "en", "c"),
        (11, "é" * 150 + " 中文 😀 <|endoftext|> ▁▁ x", "fr", "d"), (12, "x" * 400, "en", "d"),
        (13, words(9000, 6), "en", "e"),                                                          # very long
        (14, words(50, 7) + "\n" + PASSAGE + "\n" + words(50, 8), "en", "e"),
    ]
    rows += [(20 + i, words(40, 50 + i) + "\n" + LINE + f" {i}\n" + words(30, 90 + i), "en", "f") for i in range(12)]
    rows.append(rows[9])                                                                          # a repeated row
    return [(*r, len(r[1] or "")) for r in rows]


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    """A folder with ``documents``, ``pages`` and ``embeddings``, with columns whose names clash."""
    d = str(tmp_path_factory.mktemp("awkward"))
    docs = spark.createDataFrame(awkward_rows(), SCHEMA)
    for c in ("key", "row", "id", "size", "start", "length", "ids", "decoded", "n_tokens", "bits", "component_id", "spans", "leaf", "n"):
        docs = docs.selectExpr("*", f"'other' AS `{c}`")
    docs.repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(0, "http://a.b.fr/x", "<html lang='fr'><p>le la les"), (1, None, None), (2, "", ""), (2, "", "")],
                          "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    return d


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{d}/embeddings.parquet")
    return d


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
