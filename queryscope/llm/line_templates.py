"""Line deduplication with a log-template tree.

Lines are parsed by a tree of fixed depth: the first level is the number of
tokens, the next ``DEPTH`` levels are the leading tokens.  Tokens that hold
a digit are variable.  Within a leaf a token is constant at its position if
``MIN_DOCS`` different texts or more have it there, and variable otherwise; a
line whose constants make up ``CONSTANT`` of its tokens belongs to the
template of these constants, any other line is its own template.  A line of
which tokens with a digit leave less than ``CONSTANT`` is its own template as
it is, digits included, so rows of numbers are dropped only where they recur.
A template that occurs in ``MIN_DOCS`` different texts or more is boilerplate
and its lines are dropped.  Equal texts count once, and so do the lines of one
text.  A document that would lose more than ``MOST`` of its characters is left
whole: two texts that share more than 6/7 of their characters are near
duplicates at 0.75 (s / (2 - s) is more than 3/4), which document-level
deduplication deals with, and not carriers of boilerplate.

Plan.  One pass counts the leaves.  Frequent leaves are marked in a bitmap
of sixteen bits a leaf (a superset is harmless, as counts are exact later
on); a second pass sends only lines of marked leaves, each distinct line's
tokens once per task.  A line that ``MIN_DOCS`` texts have settles its tokens
and its template by its count alone; only lines of fewer texts carry the
texts they stand in, fewer than ``MIN_DOCS`` hashes each, to count different
ones.  So a line that a third of all documents have is one row.  Texts are
shuffled once, to meet the lines they lose.

Cases: null text stays null and has no lines; blank lines are kept and do
not count; lines are split at line feeds and otherwise kept byte by byte;
repeated rows are copies; an empty table gives no rows; further columns are
passed through (names beginning with two underscores are reserved).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.llm.common import documents, per_text, slices, stored

DEPTH = 3
MIN_DOCS = 10
CONSTANT = 0.7
MOST = 6, 7  # as a fraction
#: The bitmap has 2**MOST_BITS bits at most.
MOST_BITS = 28

_variable = re.compile(r"\d").search


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def masked(tokens: list[str]) -> list[str]:
    return ["<*>" if _variable(t) else t for t in tokens]


def leaf(tokens: list[str]) -> int:
    """Hash of the number of tokens and the leading ones."""
    return signed(xxhash.xxh64_intdigest("\x1f".join([str(len(tokens)), *masked(tokens[:DEPTH])])))


def line_hash(tokens: list[str]) -> int:
    """Hash of the masked line, or of the line itself where too little besides the masks is left."""
    if sum(not _variable(t) for t in tokens) < CONSTANT * len(tokens):
        return signed(xxhash.xxh64_intdigest("\x1f".join(["", *tokens])))
    return signed(xxhash.xxh64_intdigest("\x1f".join(masked(tokens))))


def leaves(docs: DataFrame) -> DataFrame:
    """leaf, once for each text that has it."""
    def run(batches):
        for b in batches:
            for texts in per_text(b.column(0), 4 << 20):
                out: list[int] = []
                for t in texts:
                    out += {leaf(k) for line in t.split("\n") if (k := line.split())}
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["leaf"])

    return docs.select("__text").mapInArrow(run, "leaf long")


def bitmap(frequent: DataFrame) -> np.ndarray:
    """Marks of hashes, about sixteen bits each; the driver gets a row for each 64 bits at most."""
    bits = min(MOST_BITS, max(12, frequent.count().bit_length() + 4))
    words = (frequent.select(F.shiftrightunsigned("leaf", 64 - bits).alias("at"))
             .select(F.shiftright("at", 6).alias("word"), F.expr("shiftleft(1L, int(at & 63))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")))
    out = np.zeros(1 << (bits - 6), dtype=np.int64)
    for r in words.toLocalIterator():
        out[r["word"]] = r["bits"]
    return out


def candidate_lines(docs: DataFrame, marks: np.ndarray) -> DataFrame:
    """key, leaf, line, tokens for lines of marked leaves, once per row; tokens once per task and line (null: variable, no constant)."""
    shift = 64 - (len(marks).bit_length() + 5)
    schema = pa.schema([("key", pa.int64()), ("copy", pa.int64()), ("leaf", pa.int64()), ("line", pa.int64()), ("tokens", pa.list_(pa.int64()))])

    def run(batches):
        sent: set[int] = set()
        for b in batches:
            at = 0
            for texts in per_text(b.column(2), 4 << 20):
                out: dict = {n: [] for n in schema.names}
                for t, key, copy in zip(texts, b.column(0).slice(at, len(texts)).to_pylist(), b.column(1).slice(at, len(texts)).to_pylist()):
                    seen = set()
                    for line in t.split("\n"):
                        k = line.split()
                        if not k:
                            continue
                        f = leaf(k)
                        bit = (f & (1 << 64) - 1) >> shift
                        if not int(marks[bit >> 6]) >> (bit & 63) & 1:
                            continue
                        h = line_hash(k)
                        if h in seen:
                            continue
                        seen.add(h)
                        tokens = None
                        if h not in sent:
                            if len(sent) >= 200_000:
                                sent.clear()
                            sent.add(h)
                            tokens = [signed(xxhash.xxh64_intdigest(x)) if x != "<*>" else None for x in masked(k)]
                        for n, v in zip(schema.names, (key, copy, f, h, tokens)):
                            out[n].append(v)
                at += len(texts)
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    return docs.select("__key", "__copy", "__text").mapInArrow(run, "key long, copy long, leaf long, line long, tokens array<long>")


def recurring(rows: DataFrame, by: list[str]) -> DataFrame:
    """The groups ``by`` that MIN_DOCS different texts have; rows: n texts, and these texts where they are fewer than MIN_DOCS."""
    alone = rows.where(F.col("n") >= MIN_DOCS).select(*by).distinct()
    few = (rows.where(F.col("n") < MIN_DOCS).select(*by, F.explode("copies").alias("copy")).distinct()
           .groupBy(*by).agg(F.count("*").alias("m")).where(F.col("m") >= MIN_DOCS).select(*by))
    return alone.union(few).distinct()


def boilerplate(lines: DataFrame) -> DataFrame:
    """line hashes whose template recurs."""
    texts = stored(lines.groupBy("line", "copy").agg(F.max("leaf").alias("leaf"), F.max("tokens").alias("tokens")), "line-texts")
    every = texts.groupBy("line").agg(F.max("leaf").alias("leaf"), F.count("*").alias("n"), F.max("tokens").alias("tokens"))
    few = texts.join(every.where(F.col("n") < MIN_DOCS).select("line"), "line").groupBy("line").agg(F.collect_list("copy").alias("copies"))
    distinct = stored(every.join(few, "line", "left"), "distinct-lines")
    tokens = distinct.select("line", "leaf", "n", "copies", F.posexplode("tokens").alias("pos", "token"))
    often = recurring(tokens.where("token is not null"), ["leaf", "pos", "token"])
    marked = tokens.drop("copies").join(often.withColumn("constant", F.lit(True)), ["leaf", "pos", "token"], "left")
    shape = marked.groupBy("line").agg(
        F.max("leaf").alias("leaf"), F.avg(F.col("constant").isNotNull().cast("int")).alias("share"),
        F.xxhash64(F.sort_array(F.collect_list(F.when(F.col("constant"), F.struct("pos", "token"))))).alias("constants"))
    named = shape.select("line", F.when(F.col("share") >= CONSTANT, F.xxhash64("leaf", "constants")).otherwise(F.xxhash64("line")).alias("template"))
    template = named.join(distinct.select("line", "n", "copies"), "line")
    return template.join(recurring(template, ["template"]), "template").select("line")


def drop_lines(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """``df`` with its text cleaned, and __lines, __dropped (numbers of lines)."""
    docs = (df.withColumn("__key", F.xxhash64(id, text)).withColumn("__copy", F.xxhash64(text))
            .withColumn("__text", F.coalesce(F.col(text).cast("string"), F.lit(""))))
    frequent = stored(leaves(docs).groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS).select("leaf"), "frequent-leaves")
    lines = stored(candidate_lines(docs, bitmap(frequent)), "candidate-lines")
    bad = boilerplate(lines)
    lists = lines.select("key", "line").join(bad, "line").groupBy(F.col("key").alias("__key")).agg(F.collect_set("line").alias("__bad"))
    joined = docs.drop("__text", "__copy").join(lists, "__key", "left").select(*df.columns, "__bad")
    src, bad_at = df.columns.index(text), len(df.columns)
    out = df.select("*", F.lit(0).cast("long").alias("__lines"), F.lit(0).cast("long").alias("__dropped")).schema

    def run(batches):
        for b in slices(batches):
            texts = b.column(src).to_pylist()
            n, lost = [], []
            for i, gone in enumerate(b.column(bad_at).to_pylist()):
                rows = texts[i].split("\n") if texts[i] else []
                n.append(len(rows))
                kept = rows
                if gone:
                    gone = set(gone)
                    kept = [x for x in rows if not (k := x.split()) or line_hash(k) not in gone]
                    if MOST[1] * (sum(map(len, rows)) - sum(map(len, kept))) > MOST[0] * sum(map(len, rows)):
                        kept = rows
                    texts[i] = "\n".join(kept)
                lost.append(len(rows) - len(kept))
            cols = [pa.array(texts, pa.string()) if i == src else c for i, c in enumerate(b.columns[:bad_at])]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(lost, pa.int64())], names=out.names)

    return joined.mapInArrow(run, out)


def op10(spark, sf_dir: str) -> DataFrame:
    done = drop_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP10_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT rid, doc_id, text, unnest(x) AS line, unnest(range(len(x))) AS pos
  FROM (SELECT *, CASE WHEN text = '' THEN [] ELSE string_split(text, chr(10)) END AS x FROM d)),
w AS (SELECT *, regexp_extract_all(line, '\\S+') AS w FROM l),
v AS (SELECT *, list_transform(w, lambda x: CASE WHEN regexp_matches(x, '\\d') THEN '<*>' ELSE x END) AS m FROM w),
m AS (SELECT *, CASE WHEN len(list_filter(m, lambda x: x <> '<*>')) < {CONSTANT} * len(m) THEN list_prepend('', w) ELSE m END AS k FROM v),
u AS (SELECT DISTINCT k, m, len(m) AS n, m[1:{DEPTH}] AS lead, md5(text) AS copy FROM m WHERE len(m) > 0),
t AS (SELECT k, n, lead, copy, unnest(m) AS x, unnest(range(n)) AS i FROM u),
c AS (SELECT n, lead, i, x FROM t WHERE x <> '<*>' GROUP BY ALL HAVING count(DISTINCT copy) >= {MIN_DOCS}),
q AS (SELECT t.k, any_value(t.n) AS n, any_value(t.lead) AS lead, count(c.x) / count(*) AS share,
    list(CASE WHEN c.x IS NULL THEN '' ELSE t.x END ORDER BY t.i) AS kept
  FROM (SELECT DISTINCT k, n, lead, x, i FROM t) t LEFT JOIN c ON c.n = t.n AND c.lead = t.lead AND c.i = t.i AND c.x = t.x GROUP BY t.k),
z AS (SELECT k, CASE WHEN share >= {CONSTANT} THEN kept ELSE list_prepend('own', k) END AS template,
    CASE WHEN share >= {CONSTANT} THEN lead ELSE [] END AS under FROM q),
often AS (SELECT template, under FROM z JOIN u USING (k) GROUP BY ALL HAVING count(DISTINCT copy) >= {MIN_DOCS}),
bad AS (SELECT k FROM z JOIN often USING (template, under)),
e AS (SELECT m.rid, any_value(m.doc_id) AS doc_id, any_value(m.text) AS text, count(*) AS n_lines, sum(len(line)) AS size,
    sum(CASE WHEN bad.k IS NULL THEN len(line) ELSE 0 END) AS kept_size, count(bad.k) AS lost,
    coalesce(array_to_string(list(line ORDER BY pos) FILTER (WHERE bad.k IS NULL), chr(10)), '') AS kept
  FROM m LEFT JOIN bad ON bad.k = m.k GROUP BY m.rid)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines,
  CASE WHEN {MOST[1]} * (size - kept_size) > {MOST[0]} * size THEN 0 ELSE coalesce(lost, 0) END AS n_dropped,
  sha256(CASE WHEN e.rid IS NULL OR {MOST[1]} * (size - kept_size) > {MOST[0]} * size THEN d.text ELSE kept END) AS kept_sha256
FROM d LEFT JOIN e ON e.rid = d.rid
"""
