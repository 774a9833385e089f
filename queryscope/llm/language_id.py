"""Language identification by Bayesian fusion of evidence.

For a row with text x, declared language d, address suffix s and host h the
posterior of language l is proportional to

    P(l | h) * P(x | l)**DISCOUNT * P(d | l) * P(s | l).

* P(x | l): hashed byte trigrams of letters and spaces (numbers, marks-up and
  keys say nothing of a language), counted over all labelled documents (of the
  ``LABELS`` most frequent labels every one that has ``LEAST`` trigrams,
  however many documents the others have) and smoothed;
  trigrams overlap, hence the discount.  One more class, undetermined, has
  all trigrams alike: noise fits it better than any language.
* P(d | l), P(s | l): smoothed shares of the text posteriors of all rows,
  by one grouped aggregation each.  Missing evidence is left out.
* P(l | h): text posteriors of all rows are summed by host, domain and in
  all; each level is smoothed towards the one above with ``WEIGHT``
  pseudo-rows, the row's own part taken off, so no row is its own witness.

A row is rejected if undetermined wins or its text has no trigram.  A
document whose label has no class is not rejected for that: where
undetermined wins, it keeps its label.

Every table that grows is joined by key, never broadcast; the model sent to
the tasks has ``FEATURES`` rows per language.

Cases: null or empty text is rejected; null declared language, suffix or
host is no evidence; unknown declared values count as values of their own;
repeated rows are judged alike; without any labelled document every row is
rejected; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from queryscope.llm.common import documents, per_text, small_batches, stored, text_or_empty

FEATURES = 1 << 14
LABELS = 1000   # far above the languages of any labelled corpus
LEAST = 1000    # trigrams: a class of fewer is hardly other than undetermined
DISCOUNT = 0.2
HELD = 4096     # vectors a task holds before it sends them
WEIGHT = 5.0

_low = np.arange(256, dtype=np.uint32)
_low[65:91] += 32
_low[[9, 10, 11, 12, 13]] = 32
_letter = np.zeros(256, dtype=bool)  # letters, their UTF-8 bytes, spaces and apostrophes
_letter[[9, 10, 11, 12, 13, 32, 39, *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of letters in order, and the first of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(r) for r in raw], dtype=np.int64)
    joined = np.frombuffer(b"".join(raw), dtype=np.uint8)
    data, letter = _low[joined], _letter[joined]
    n = np.maximum(size - 2, 0)
    first = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(n, out=first[1:])
    at = np.arange(first[-1]) + np.repeat(np.cumsum(size) - size - first[:-1], n)
    good = letter[at] & letter[at + 1] & letter[at + 2] if len(at) else np.zeros(0, dtype=bool)
    kept = np.zeros(len(at) + 1, dtype=np.int64)
    np.cumsum(good, out=kept[1:])
    at = at[good]
    code = (data[at] << np.uint32(16)) | (data[at + 1] << np.uint32(8)) | data[at + 2] if len(at) else np.zeros(0, np.uint32)
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64), kept[first]


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log P(trigram | language), with the undetermined class last."""
    labelled = labelled.where("lang is not null and text is not null").select("lang", "text")
    rows = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    langs = sorted(r["lang"] for r in rows.orderBy(F.desc("n"), "lang").limit(LABELS).collect())
    schema = pa.schema([("lang", pa.int32()), ("feature", pa.int32()), ("n", pa.int64())])
    index = {l: i for i, l in enumerate(langs)}

    def count(batches):
        total = np.zeros((len(langs), FEATURES), dtype=np.int64)
        for b in batches:
            at = 0
            own = b.column(0).to_pylist()
            for texts in per_text(b.column(1), 1 << 18):
                f, first = trigrams(texts)
                lang = np.array([index.get(l, -1) for l in own[at:at + len(texts)]])
                at += len(texts)
                of = np.repeat(lang, np.diff(first))
                for i in np.unique(lang[lang >= 0]):
                    total[i] += np.bincount(f[of == i], minlength=FEATURES)
        i, f = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(f.astype(np.int32)), pa.array(total[i, f])], schema=schema)

    table = np.zeros((len(langs) + 1, FEATURES))
    if langs:
        counted = labelled.mapInArrow(count, "lang int, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
        with small_batches(labelled.sparkSession):
            for r in counted.toLocalIterator():
                table[r["lang"], r["feature"]] = r["n"]  # languages * FEATURES rows at most
        some = table[:-1].sum(1) >= LEAST
        langs, table = [l for l, s in zip(langs, some) if s], table[np.append(some, True)]
    table += 0.5
    return langs, np.log(table / table.sum(1, keepdims=True)).T.astype(np.float32).copy()


def plain(markup: str) -> str:
    """Text of a web page."""
    body = re.sub(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ", markup)
    return html.unescape(re.sub(r"(?s)<[^>]*>", " ", body))


def scored(df: DataFrame, model: np.ndarray, markup: bool = False) -> DataFrame:
    """``df`` without its text, with ``n`` trigrams, ``score`` (discounted log-likelihoods) and ``p`` (posterior of the text alone)."""
    kept = [c for c in df.columns if c != "text"]
    empty = F.array(F.lit(0.0))
    out = df.select(*kept, F.lit(0).cast("long").alias("n"), empty.alias("score"), empty.alias("p")).schema
    at_text = df.columns.index("text")
    width = model.shape[1]
    some = max(1 << 12, min(1 << 18, (1 << 22) // width))  # trigrams whose scores are held at once

    def run(batches):
        for b in batches:
            at = 0
            for texts in per_text(b.column(at_text), some):
                f, first = trigrams([plain(t) for t in texts] if markup else texts)
                total = np.zeros((len(texts), width))
                if len(f) <= 2 * some:
                    full = np.flatnonzero(np.diff(first))
                    if len(full):
                        total[full] = np.add.reduceat(model[f], first[:-1][full], axis=0, dtype=np.float64)
                else:  # one long text
                    for i, (x, y) in enumerate(zip(first[:-1], first[1:])):
                        for z in range(x, y, some):
                            total[i] += model[f[z:min(y, z + some)]].sum(0, dtype=np.float64)
                part = b.slice(at, len(texts))
                at += len(texts)
                total *= DISCOUNT
                cols = [c for i, c in enumerate(part.columns) if i != at_text]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(np.diff(first)), lists(total), lists(softmax(total))], names=out.names)

    return df.mapInArrow(run, out)


def softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def sums(rows: DataFrame, key: str) -> DataFrame:
    """key, n: the sum of the vectors ``p`` of each key; tasks add up theirs first, so a host of very many rows is a row a task."""
    def run(batches):
        held: dict = {}

        def send():
            done = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), lists(np.array(list(held.values())))], names=[key, "p"])
            held.clear()
            return done

        for b in batches:
            p = b.column(1).flatten().to_numpy().reshape(b.num_rows, -1) if b.num_rows else []
            for k, v in zip(b.column(0).to_pylist(), p):
                if k in held:
                    held[k] += v
                else:
                    held[k] = v.copy()
            if len(held) >= HELD:
                yield send()
        if held:
            yield send()

    each = rows.where(F.col(key).isNotNull()).select(key, "p").mapInArrow(run, f"`{key}` string, p array<double>")
    total = each.select(key, F.posexplode("p").alias("pos", "x")).groupBy(key, "pos").agg(F.sum("x").alias("x"))
    return total.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda v: v["x"]).alias("n"))


def fused(rows: DataFrame, langs: list[str]) -> DataFrame:
    """``rows`` (declared, suffix, domain, host, n, score) with lang, posterior, accepted.

    ``lang`` is null where the row is rejected.
    """
    width = len(langs) + 1
    base = stored(rows, "language-scores")
    everything = base.where("n > 0")
    nothing = F.array_repeat(F.lit(0.0), width)
    every = sums(everything.select(F.lit("").alias("all"), "p"), "all")
    overall = F.broadcast(every.agg(F.coalesce(F.first("n"), nothing).alias("overall")))  # one row

    def likelihood(key: str) -> DataFrame:
        """key, log P(key | language)."""
        by = sums(everything, key)
        per_label = by.select(F.posexplode("n").alias("pos", "x")).groupBy("pos").agg(F.sum("x").alias("x"))
        total = per_label.agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda v: v["x"]).alias("t"))
        values = by.agg(F.count("*").alias("values"))
        return by.crossJoin(F.broadcast(total.crossJoin(values))).select(key, F.zip_with(  # one row
            "n", "t", lambda n, t: F.log((n + 0.5) / (t + 0.5 * F.col("values")))).alias(f"{key}_score"))

    def counts(key: str) -> DataFrame:
        return sums(everything, key).withColumnRenamed("n", f"{key}_n")

    joined = base.crossJoin(overall)
    for key in ("declared", "suffix"):
        joined = joined.join(likelihood(key), key, "left")
    for key in ("domain", "host"):
        joined = joined.join(counts(key), key, "left")
    kept = [c for c in rows.columns if c not in ("n", "score", "p")]
    parts = ("n", "p", "score", "overall", "domain_n", "host_n", "declared_score", "suffix_score")
    names = [*langs, None]
    classes = set(langs)

    def decide(batches):
        for b in batches:
            part = {c: b.column(len(kept) + i) for i, c in enumerate(parts)}
            some = part["n"].to_numpy() > 0

            def matrix(c, empty=0.0):
                out = np.full((b.num_rows, width), empty)
                there = part[c].is_valid().to_numpy(zero_copy_only=False)
                out[there] = part[c].drop_null().flatten().to_numpy().reshape(-1, width)
                return out

            own = matrix("p") * some[:, None]
            prior = np.full((b.num_rows, width), 1.0 / width)
            for c in ("overall", "domain_n", "host_n"):
                there = part[c].is_valid().to_numpy(zero_copy_only=False)[:, None]
                n = np.maximum(matrix(c) - own * there, 0.0)
                prior = (n + WEIGHT * prior) / (n.sum(1, keepdims=True) + WEIGHT)
            fused_ = np.log(prior) + matrix("score") + matrix("declared_score") + matrix("suffix_score")
            post = np.exp(fused_ - fused_.max(1, keepdims=True))
            post /= post.sum(1, keepdims=True)
            best = post.argmax(1)
            found = [names[i] if s else None for i, s in zip(best, some)]
            for i in np.flatnonzero(some & (best == width - 1) & b.column(kept.index("page_id")).is_null().to_numpy(zero_copy_only=False)):
                label = b.column(kept.index("declared"))[int(i)].as_py()
                found[i] = None if label in classes else label  # no class, so nothing speaks against the label
            good = np.array([x is not None for x in found], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(kept)], pa.array(found, pa.string()),
                 pa.array(post.max(1)), pa.array(good)], names=[*kept, "lang", "posterior", "accepted"])

    schema = StructType([*joined.select(*kept).schema.fields, StructField("lang", StringType()),
                         StructField("posterior", DoubleType()), StructField("accepted", BooleanType())])
    return joined.select(*kept, *parts).mapInArrow(decide, schema)


def document_rows(docs: DataFrame) -> DataFrame:
    """Evidence of documents: the source stands for the host."""
    return docs.select(
        F.xxhash64("doc_id", "text", "lang", "source").alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("page_id"), F.col("lang").alias("declared"), F.lit(None).cast("string").alias("suffix"),
        F.lit(None).cast("string").alias("domain"), F.col("source").alias("host"), text_or_empty().alias("text"))


def page_rows(pages: DataFrame) -> DataFrame:
    """Evidence of web pages: markup language, address suffix, domain and host."""
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), F.lit(""))
    parts = F.split(host, r"\.")
    declared = F.nullif(F.lower(F.regexp_extract("html", r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", 1)), F.lit(""))
    return pages.select(
        F.xxhash64("page_id", "url", "html").alias("key"), F.lit(None).cast("long").alias("doc_id"),
        F.col("page_id").cast("long").alias("page_id"), declared.alias("declared"),
        F.when(F.size(parts) > 1, F.element_at(parts, -1)).alias("suffix"),
        F.when(F.size(parts) > 1, F.concat_ws(".", F.slice(parts, -2, 2))).alias("domain"), host.alias("host"),
        text_or_empty("html").alias("text"))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that are accepted, with ``lang`` as identified."""
    langs, model = fit(docs)
    done = fused(scored(document_rows(docs), model), langs)
    kept = done.where("accepted").groupBy(F.col("key").alias("__key")).agg(F.min("lang").alias("__lang"))
    return (docs.withColumn("__key", F.xxhash64("doc_id", "text", "lang", "source")).join(kept, "__key")
            .select(*[F.col("__lang").alias("lang") if c == "lang" else F.col(c) for c in docs.columns]))


def op3(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    langs, model = fit(docs)
    rows = scored(document_rows(docs), model).unionByName(
        scored(page_rows(spark.read.parquet(f"{sf_dir}/pages.parquet")), model, markup=True))
    return fused(rows, langs).select("doc_id", "page_id", "host", "declared", "suffix", "lang", "posterior", "accepted")
