"""Exact removal of repeated byte strings by bucket-pointer refinement.

Every byte covered by a ``length``-byte string that also starts earlier
(smaller document id, or earlier in the same document) is removed; overlaps
count, and strings are judged on the input.

Method.  Suffixes need sorting only as far as ``length`` bytes, and only
where a string can occur twice.

1. *Initial buckets.*  Each string has a least ``Q``-gram (by hash, the
   leftmost among equals), its anchor.  Anchors are dealt out by that gram;
   buckets of one anchor are dropped, as no string there repeats.
2. *Refinement.*  Around each anchor left, the bytes of its strings go to
   the bucket.  Positions are first put in buckets of ``WORD`` equal bytes;
   sorting on the bucket pointers of a position and of a later offset gives
   buckets of twice as many, whose pointers the next step takes, and so on up
   to ``length`` (8, 16, 32, 64, 100 bytes).  Positions alone in their bucket
   leave the next sort, together with every string that crosses them.  These
   buckets compare bytes, not hashes.  Equal surroundings are refined once,
   for their earliest place.
3. *Frequent anchors* (more than ``HOT`` places, such as a line that a third
   of all documents have) are split: their strings are dealt out singly by
   whole-string hash, the earliest of each task only.

Spans meet their texts by document id.  Anchors and the strings of frequent
ones use 64-bit hashes.

Cases: null text counts as empty; shorter texts keep all bytes; rows that
repeat an id are one document (its smallest text); rows without an id have
no place in the order: they are returned whole; an empty table gives no
rows; further columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.llm.common import buckets_for, documents, ids_and_texts, per_text
from queryscope.llm.passages import compact_windows, runs_of, undealt
from queryscope.llm.words import mix, powers

LENGTH = 100
Q = 20
WORD = 8              # bytes of the initial buckets of a refinement
HOT = 256
BUCKETS = 48          # at least; a bucket is sorted in one task
BUCKET_BYTES = 16 << 20  # of the input's files, for a bucket
HELD = 500_000       # anchors a task holds before it sends them
HELD_BYTES = 8 << 20
REFINED = 1 << 20    # bytes that a task refines at a time
SEED = np.uint64(0x8BB84B93962EACC9)


def gram_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sum, from which the hash of any gram follows."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[0], out=total[1:])
    return total


def grams(total: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
    return mix((total[at + q] - total[at]) * powers(len(total))[1][at])


ANCHOR = np.dtype([("value", "<u8"), ("pos", "<u4"), ("back", "u1"), ("ahead", "u1")])
LISTED = np.dtype([*ANCHOR.descr, ("hot", "?")])


def anchors_of(texts: list[bytes], length: int):
    """(text, value, pos, back, ahead): strings starting at pos - back .. pos - ahead have their anchor at pos."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(size, out=offsets[1:])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n = np.maximum(size - Q + 1, 0)
    first = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(n, out=first[1:])
    at = np.arange(first[-1]) + np.repeat(offsets[:-1] - first[:-1], n)
    g = grams(gram_sums(data), at, Q)
    span = length - Q
    own, c, l, r, _ = compact_windows(g, first, span + 1, SEED)
    back = c - np.maximum(l, c - span)
    ahead = c - np.minimum(c, r - span)
    return own, g[first[own] + c], c, back, ahead


def dealt(w: np.ndarray, ids: np.ndarray, buckets: int):
    """(bucket, their places, records, ids and counts of runs of one document), records in their order."""
    bucket = (w["value"] % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for i in np.flatnonzero(cut[1:] > cut[:-1]).tolist():
        part = order[cut[i]:cut[i + 1]]
        yield i, part, w[part], *runs_of(ids[part])


def repeated_anchors(docs: DataFrame, buckets: int, length: int) -> DataFrame:
    """doc_id, at: packed LISTED records of the anchors whose gram is the anchor of two places or more."""
    schema = pa.schema([("bucket", pa.int32()), ("anchors", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary())])
    hot = HOT

    def send(held):
        w, ids = np.concatenate([h for h, _ in held]), np.concatenate([i for _, i in held])
        for i, _, x, own, n in dealt(w, ids, buckets):
            yield pa.RecordBatch.from_pydict({"bucket": [i], "anchors": [x.tobytes()], "ids": [own.tobytes()], "counts": [n.tobytes()]}, schema=schema)

    def emit(batches):
        held, n = [], 0
        for b in batches:
            at = 0
            for texts in per_text(b.column(1), 1 << 20):
                ids = b.column(0).slice(at, len(texts)).to_numpy().astype(np.int64)
                at += len(texts)
                own, value, pos, back, ahead = anchors_of([t.encode("utf-8", "surrogatepass") for t in texts], length)
                w = np.zeros(len(own), dtype=ANCHOR)
                w["value"], w["pos"], w["back"], w["ahead"] = value, pos, back, ahead
                held.append((w, ids[own]))
                n += len(w)
                if n >= HELD:
                    yield from send(held)
                    held, n = [], 0
        if n:
            yield from send(held)

    out = pa.schema([("doc_id", pa.int64()), ("at", pa.binary())])

    def count(table: pa.Table) -> pa.Table:
        ws, ds = [], []
        for r in range(table.num_rows):
            w = np.frombuffer(table.column("anchors")[r].as_buffer(), dtype=ANCHOR)
            ds.append(undealt(table.column("ids")[r], table.column("counts")[r]))
            ws.append(w)
        w, d = np.concatenate(ws), np.concatenate(ds)
        order = np.argsort(w["value"])
        v = w["value"][order]
        often = np.zeros(len(v), dtype=bool)
        often[1:] = v[1:] == v[:-1]
        often[:-1] |= often[1:]
        order = order[often]
        w, d = w[order], d[order]
        order = np.lexsort((w["pos"], d, w["value"]))
        w, d = w[order], d[order]
        new = np.ones(len(w), dtype=bool)  # rows that repeat an id have their anchors twice
        new[1:] = (w["value"][1:] != w["value"][:-1]) | (d[1:] != d[:-1]) | (w["pos"][1:] != w["pos"][:-1])
        w, d = w[new], d[new]
        if not len(w):
            return out.empty_table()
        start = np.flatnonzero(np.concatenate([[True], w["value"][1:] != w["value"][:-1]]))
        n = np.repeat(np.diff(np.append(start, len(w))), np.diff(np.append(start, len(w))))
        k = np.flatnonzero(n > 1)
        k = k[np.argsort(d[k], kind="stable")]
        if not len(k):
            return out.empty_table()
        x = np.zeros(len(k), dtype=LISTED)
        for c in ("value", "pos", "back", "ahead"):
            x[c] = w[c][k]
        x["hot"] = n[k] > hot
        own, many = runs_of(d[k])
        offsets = np.append(0, np.cumsum(many.astype(np.int64))) * LISTED.itemsize
        at = pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())])
        return pa.table([own, at], schema=out)

    sent = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(emit, "bucket int, anchors binary, ids binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(count, "doc_id long, at binary")


WHOLE = np.dtype([("value", "<u8"), ("pos", "<u4")])


def strings_around(texts: DataFrame, anchors: DataFrame, buckets: int, length: int) -> DataFrame:
    """The bytes around each repeated anchor, dealt out by its gram; whole strings of frequent ones by their hash."""
    lists = anchors.groupBy("doc_id").agg(F.collect_list("at").alias("at"))
    joined = texts.join(lists, "doc_id").select("doc_id", "text", "at")
    schema = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("records", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()), ("bytes", pa.binary())])

    def row(bucket, kind, records, ids, counts, raw=b""):
        return pa.RecordBatch.from_pydict({"bucket": [bucket], "kind": [kind], "records": [records.tobytes()],
                                           "ids": [ids.tobytes()], "counts": [counts.tobytes()], "bytes": [raw]}, schema=schema)

    def send(cold, hot):
        if cold:
            w = np.concatenate([c[0] for c in cold])
            ids = np.concatenate([c[1] for c in cold])
            raw = [x for c in cold for x in c[2]]
            for i, part, x, own, n in dealt(w, ids, buckets):
                yield row(i, 0, x, own, n, b"".join([raw[k] for k in part.tolist()]))
        if hot:
            w, ids = np.concatenate([h for h, _ in hot]), np.concatenate([i for _, i in hot])
            order = np.lexsort((w["pos"], ids, w["value"]))
            w, ids = w[order], ids[order]
            new = np.ones(len(w), dtype=bool)
            new[1:] = w["value"][1:] != w["value"][:-1]
            for i, _, x, own, n in dealt(w[new], ids[new], buckets):
                yield row(i, 1, x, own, n)
            # later places in this task repeat whatever the others hold: only passed on
            rest = w[~new]
            if len(rest):
                own, n = runs_of(ids[~new])
                yield row(int(own[0] % buckets), 2, rest, own, n)

    def emit(batches):
        cold, hot, held = [], [], 0
        for b in batches:
            for i in range(b.num_rows):
                doc = b.column(0)[i].as_py()
                text = b.column(1)[i].as_py().encode("utf-8", "surrogatepass")
                v = np.frombuffer(b"".join(b.column(2)[i].as_py()), dtype=LISTED)
                pos, back, ahead = (v[k].astype(np.int64) for k in ("pos", "back", "ahead"))
                value, hot_ = v["value"], v["hot"]
                total = gram_sums(np.frombuffer(text, dtype=np.uint8))
                real = (pos - ahead + length <= len(text)) & (pos + Q <= len(text))  # a repeated id may have another text
                real[real] = grams(total, pos[real], Q) == value[real]
                c = np.flatnonzero(real & ~hot_)
                if len(c):
                    w = np.zeros(len(c), dtype=ANCHOR)
                    w["value"], w["pos"], w["back"], w["ahead"] = value[c], pos[c], back[c], ahead[c]
                    raw = [text[p - k:p - a + length] for p, k, a in zip(pos[c].tolist(), back[c].tolist(), ahead[c].tolist())]
                    cold.append((w, np.full(len(c), doc, dtype=np.int64), raw))
                    held += sum(map(len, raw))
                h = np.flatnonzero(real & hot_)
                if len(h):
                    many = back[h] - ahead[h] + 1
                    s = np.repeat(pos[h] - back[h], many) + (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
                    w = np.zeros(len(s), dtype=WHOLE)
                    w["value"], w["pos"] = grams(total, s, length), s
                    hot.append((w, np.full(len(s), doc, dtype=np.int64)))
                    held += 16 * len(s)
                if held >= HELD_BYTES:
                    yield from send(cold, hot)
                    cold, hot, held = [], [], 0
        yield from send(cold, hot)

    return joined.mapInArrow(emit, "bucket int, kind int, records binary, ids binary, counts binary, bytes binary")


def firsts_of(key: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(s, least s of the same key) of the positions whose key another one has."""
    order = np.argsort(key)
    k = key[order]
    start = np.flatnonzero(np.concatenate([np.ones(min(1, len(k)), dtype=bool), k[1:] != k[:-1]]))
    many = np.diff(np.append(start, len(k)))
    first = np.repeat(np.minimum.reduceat(s[order], start) if len(start) else start, many)
    shared = np.repeat(many > 1, many)
    return s[order][shared], first[shared]


def refined(data: np.ndarray, base: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, bucket pointer) of the ``length``-byte strings of the pieces of ``data`` that occur twice.

    A bucket pointer is the first position of the bucket.  Buckets of the
    first ``WORD`` bytes are the bytes themselves; a step sorts the positions
    on (own pointer, pointer as far behind as the pointers reach), which
    doubles the bytes that the new pointers stand for.  A position alone in
    its bucket loses its pointer, and with it every string that crosses it.
    """
    width = min(WORD, length)
    n = np.maximum(size - width + 1, 0)
    s = np.arange(n.sum()) + np.repeat(base - (np.cumsum(n) - n), n)
    gram = np.zeros(max(0, len(data) - width + 1), dtype=np.uint64)
    for k in range(width):
        gram |= data[k:k + len(gram)].astype(np.uint64) << np.uint64(8 * k)
    s, first = firsts_of(gram[s], s)
    pointer = np.full(len(data) + 1, -1, dtype=np.int64)
    while width < length:
        pointer[:] = -1
        pointer[s] = first
        step = min(width, length - width)
        later = pointer[np.minimum(s + step, len(data))]  # no pointer reaches over the end of a piece
        keep = (later >= 0) & (np.searchsorted(base, s, side="right") == np.searchsorted(base, s + step, side="right"))
        s, first = firsts_of(first[keep] * (len(data) + 1) + later[keep], s[keep])
        width += step
    return s, first


def starts_again(w: np.ndarray, d: np.ndarray, raw: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of the strings that start earlier too, among the anchors of a bucket."""
    order = np.lexsort((w["pos"], d))
    w, d = w[order], d[order]
    raw = [raw[i] for i in order.tolist()]
    seen: dict[tuple[int, bytes], int] = {}
    firsts, later = [], np.zeros(len(w), dtype=bool)
    for i, k in enumerate(zip(w["value"].tolist(), raw, w["back"].tolist())):
        if k in seen:
            later[i] = True  # the same surroundings stood earlier: all its strings repeat
        else:
            seen[k] = i
            firsts.append(i)
    docs, starts = [], []
    i = np.flatnonzero(later)
    if len(i):
        many = (w["back"][i].astype(np.int64) - w["ahead"][i]) + 1
        docs.append(np.repeat(d[i], many))
        starts.append(np.repeat(w["pos"][i].astype(np.int64) - w["back"][i], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
    i = np.array(firsts)
    raws = [raw[k] for k in firsts]
    size = np.array([len(x) for x in raws], dtype=np.int64)
    base = np.cumsum(size) - size
    s, first = refined(np.frombuffer(b"".join(raws), dtype=np.uint8), base, size, length)
    again = s != first
    s = s[again]
    own = np.searchsorted(base, s, side="right") - 1
    docs.append(d[i[own]])
    starts.append(w["pos"][i[own]].astype(np.int64) - w["back"][i[own]] + s - base[own])
    return np.concatenate(docs), np.concatenate(starts)


def spans(strings: DataFrame, length: int) -> DataFrame:
    """doc_id, from, to: runs of bytes to remove, as found in each bucket."""
    schema = pa.schema([("doc_id", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])

    def refine(table: pa.Table) -> pa.Table:
        cold_w, cold_d, raw, hot_w, hot_d = [], [], [], [], []
        docs, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in range(table.num_rows):
            kind = table.column("kind")[r].as_py()
            w = np.frombuffer(table.column("records")[r].as_buffer(), dtype=WHOLE if kind else ANCHOR)
            d = undealt(table.column("ids")[r], table.column("counts")[r])
            if kind == 0:
                data = table.column("bytes")[r].as_py()
                end = np.cumsum(w["back"].astype(np.int64) - w["ahead"] + length).tolist()
                raw += [data[a:b] for a, b in zip([0, *end[:-1]], end)]
                cold_w.append(w)
                cold_d.append(d)
            elif kind == 1:
                hot_w.append(w)
                hot_d.append(d)
            else:
                docs.append(d)
                starts.append(w["pos"].astype(np.int64))
        if cold_w:
            w, d = np.concatenate(cold_w), np.concatenate(cold_d)
            order = np.argsort(w["value"], kind="stable")
            value = w["value"][order]
            size = np.cumsum([len(raw[i]) for i in order.tolist()])
            at = 0
            while at < len(order):  # whole anchors, as many as fit
                end = int(np.searchsorted(size, (size[at - 1] if at else 0) + REFINED, side="right"))
                end = int(np.searchsorted(value, value[max(at, min(end, len(order) - 1))], side="right"))
                part = order[at:end]
                a, b = starts_again(w[part], d[part], [raw[i] for i in part.tolist()], length)
                docs.append(a)
                starts.append(b)
                at = end
        if hot_w:
            w, d = np.concatenate(hot_w), np.concatenate(hot_d)
            order = np.lexsort((w["pos"], d, w["value"]))
            again = order[1:][w["value"][order[1:]] == w["value"][order[:-1]]]
            docs.append(d[again])
            starts.append(w["pos"][again].astype(np.int64))
        d, s = np.concatenate(docs), np.concatenate(starts)
        order = np.lexsort((s, d))
        d, s = d[order], s[order]
        if not len(d):
            return schema.empty_table()
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] > s[:-1] + length)])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(d)) - 1
        return pa.table([d[a], s[a], s[b] + length], schema=schema)

    return strings.groupBy("bucket").applyInArrow(refine, "doc_id long, from long, to long")


def without_repeats(df: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, removed array<struct<from, to>> (maximal runs), kept binary."""
    buckets = buckets_for(df, BUCKETS, BUCKET_BYTES, 1 << 20)
    docs = ids_and_texts(df, text)
    texts = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min("text").alias("text"))
    found = spans(strings_around(texts, repeated_anchors(docs, buckets, length), buckets, length), length)
    lists = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("spans"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()),
                        ("removed", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))), ("kept", pa.binary())])

    def cut(batches):
        for b in batches:
            out: dict = {n: [] for n in schema.names}
            size = 0
            for doc, t, found_ in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                raw = t.as_py().encode("utf-8", "surrogatepass")
                runs: list[dict] = []
                for s in found_.as_py() or ():
                    if runs and s["from"] <= runs[-1]["to"]:
                        runs[-1]["to"] = max(runs[-1]["to"], s["to"])
                    else:
                        runs.append(dict(s))
                kept, at = [], 0
                for s in runs:
                    kept.append(raw[at:s["from"]])
                    at = s["to"]
                for n, v in zip(schema.names, (doc, len(raw), runs, b"".join([*kept, raw[at:]]))):
                    out[n].append(v)
                size += len(raw)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pydict(out, schema=schema)
                    out, size = {n: [] for n in schema.names}, 0
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    whole = texts.join(lists, "doc_id", "left").unionByName(
        docs.where("doc_id is null").withColumn("spans", F.lit(None).cast("array<struct<from:bigint,to:bigint>>")))
    return whole.select("doc_id", "text", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, removed array<struct<from:bigint,to:bigint>>, kept binary")


def op7(spark, sf_dir: str) -> DataFrame:
    done = without_repeats(documents(spark, sf_dir))
    return done.select(
        "doc_id", "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = """
WITH t AS (SELECT doc_id, hex(encode(min(coalesce(text, '')))) AS h FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id),
p AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS m FROM (
  SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS i FROM t WHERE len(h) >= 200)),
k AS (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS k FROM p),
f AS (SELECT doc_id, i, CASE WHEN i > 100 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 1 ELSE 0 END AS fresh FROM k WHERE k > 1),
g AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM f),
r AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM g GROUP BY doc_id, run),
l AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM r GROUP BY doc_id),
d AS (SELECT t.doc_id, h, len(h) // 2 AS n, coalesce(a, []) AS a, coalesce(b, []) AS b FROM t LEFT JOIN l ON l.doc_id = t.doc_id
  UNION ALL SELECT doc_id, hex(encode(coalesce(text, ''))), strlen(coalesce(text, '')), [], [] FROM documents WHERE doc_id IS NULL)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(list_sum(b), 0) - coalesce(list_sum(a), 0) AS BIGINT) AS n_removed,
  CAST(len(a) AS BIGINT) AS n_spans,
  sha256(unhex(array_to_string(list_transform(range(1, len(a) + 2), lambda j:
    substr(h, 2 * coalesce(b[j - 1], 0) + 1, 2 * (coalesce(a[j], n) - coalesce(b[j - 1], 0)))), ''))) AS kept_sha256
FROM d
"""
