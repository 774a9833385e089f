"""Exact top-k search by inner product with pivot tables.

Method.  In a block of largest norm M each vector x is lifted to
(x, sqrt(M^2 - |x|^2)) and a query q to (q, 0); then
|x' - q'|^2 = M^2 + |q|^2 - 2 x.q, so the largest products are the smallest
distances.  Pivots are vectors of the table, the same for all blocks and
lifted like queries: farthest-first picks among the ``SAMPLE`` rows of the
least id hash (a bounded sample; any pivots give exact results).  Each row
goes to the cell of its nearest pivot, and the rows of a cell are cut into
blocks; a block keeps the distances of its vectors to every pivot and their
span.  For a query the largest |d(x', p) - d(q', p)| over the pivots bounds
d(x', q') from below.

1. Each query is searched in the largest block of its own cell; the k-th
   product found there is a threshold.
2. Pairs of a query block and a candidate block whose spans say that no
   product reaches the least threshold are left out.
3. In the pairs left, candidates are evaluated exactly in the order of their
   bound; the search in a block stops when the bound says that no other can
   reach the threshold or the k-th product found, ties included.  Only
   products that reach the threshold leave the block, and the lists meet by
   query.

The queries are a stated share of the rows (ids divisible by 50), also cut
into blocks; rows are dealt out by (cell, id) ranges, so a cell that holds a
third of all rows, or many equal vectors, is many blocks on many tasks.
Bounds serve while sums are exact in a double; beyond that all candidates
are evaluated.

Cases: rows whose id or vector is null, or whose vector holds null or
non-finite components, take no part; rows that repeat an id count once,
with the smallest vector; shorter vectors count as filled up with zeros; an
empty table gives no rows; components whose 256-fold is beyond a double are
the largest double; scores beyond a 64-bit integer are its largest or
smallest value, and tie there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queryscope.llm.common import stored

BLOCK = 4096       # candidates per block
QUERY_BLOCK = 256  # queries per block, at most
PIVOTS = 64
SAMPLE = 2048      # rows the pivots are picked from
FIRST = 64         # candidates evaluated at first, then as many again each time
EXACT = 2.0 ** 53
LEAST, MOST = -2 ** 63, 2 ** 63 - 1
LARGEST = np.finfo(np.float64).max


def usable(df: DataFrame) -> DataFrame:
    """One row per id whose components are all finite: vec_id, v array<double>."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def stacked(rows: list) -> np.ndarray:
    out = np.zeros((len(rows), max(1, max(map(len, rows)))))
    for r, v in zip(out, rows):
        r[:len(v)] = v
    with np.errstate(over="ignore"):
        return np.clip(np.floor(256.0 * out), -LARGEST, LARGEST)


def vectors(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(v.values.to_numpy(zero_copy_only=False), dtype=np.float64) for v in column]


def packed(batches, rows_per_block: int):
    """(cell, ids, integer matrix) of at most ``rows_per_block`` rows of one cell, over the batches (cell, id, vector) of a task."""
    at, ids, rows = None, [], []
    for b in batches:
        for cell, i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), vectors(b.column(2))):
            if ids and (cell != at or len(ids) == rows_per_block):
                yield at, np.array(ids, dtype=np.int64), stacked(rows)
                ids, rows = [], []
            at = cell
            ids.append(i)
            rows.append(v)
    if ids:
        yield at, np.array(ids, dtype=np.int64), stacked(rows)


def squared(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (x * x).sum(1)


def exact(*squares: float) -> bool:
    """Whether all sums of products of vectors of these squared norms are exact in a double."""
    return sum(squares) < EXACT / 8


def distances(x: np.ndarray, x2, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots; ``x2``: squared norms of the (lifted) rows, of which all count as ``pivots`` at the last 0."""
    d = min(x.shape[1], pivots.shape[1])
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt(np.maximum(0.0, np.reshape(x2, (-1, 1)) + squared(pivots) - 2 * x[:, :d] @ pivots[:, :d].T))


def farthest_first(x: np.ndarray, many: int) -> np.ndarray:
    """Rows of ``x``, each the one farthest from those before."""
    x2 = squared(x)
    x = x[x2 < EXACT / 64]  # vectors whose distances are exact
    if not len(x):
        return np.zeros((0, 1))
    x2, picks, near = squared(x), [], np.full(len(x), np.inf)
    at = int(np.argmax(x2))
    while len(picks) < many and near[at] > 0:
        picks.append(at)
        near = np.minimum(near, distances(x, x2, x[at:at + 1])[:, 0])
        at = int(np.argmax(near))
    return x[picks]


def pivot_table(x: np.ndarray, m2: float, pivots: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pivots (farthest-first among ``x`` where none are given) and the distances of all rows, lifted to norm m2, to them."""
    pivots = farthest_first(x, PIVOTS) if pivots is None else pivots
    return pivots, distances(x, m2, pivots)


def products(x: np.ndarray, q: np.ndarray) -> list[int] | np.ndarray:
    """Exact integer products within a 64-bit integer; doubles serve while every sum fits in 53 bits."""
    if len(x) == 0 or np.abs(x).max() * np.abs(q).max() * max(1, len(q)) < EXACT:
        return x @ q
    qi = [int(c) for c in q]
    return np.array([max(LEAST, min(MOST, sum(int(a) * b for a, b in zip(r, qi)))) for r in x], dtype=object)


def search(ids, x, m2, pivots, table, qid: int, q: np.ndarray, k: int, least: float = -np.inf) -> list[tuple[int, int]]:
    """The k best (score, vec_id) of one block for one query, of those that reach ``least``."""
    q2 = float(squared(q[None, :])[0])
    dq = distances(q[None, :], q2, pivots)[0]
    q = np.concatenate([q[:x.shape[1]], np.zeros(max(0, x.shape[1] - len(q)))])
    low = np.abs(table - dq).max(1, initial=0.0)
    sure = exact(m2, q2)
    ceiling = (m2 + q2 - low * low) / 2 if sure else np.full(len(x), np.inf)
    slack = 0.5 + 1e-9 * (m2 + q2)  # rounding of the bound
    order = np.argsort(low, kind="stable")
    best: list[tuple[int, int]] = []
    at, step = 0, FIRST
    while at < len(order):
        reach = max(least, best[-1][0]) if len(best) == k else least
        if sure and ceiling[order[at]] + slack < reach:
            break
        take = order[at:at + step]
        at, step = at + step, step * 2
        take = take[ids[take] != qid]
        s = products(x[take], q)
        if least > -np.inf:
            take, s = take[s >= least], s[s >= least]
        if len(s) > k:  # only those that reach the k-th of this run matter, ties included
            keep = s >= np.partition(s, len(s) - k)[len(s) - k]
            take, s = take[keep], s[keep]
        best = sorted([*best, *((int(a), int(i)) for a, i in zip(s, ids[take]))], key=lambda t: (-t[0], t[1]))[:k]
    return best


BLOCKS = "cell int, cb string, n long, m2 double, sure boolean, lo array<double>, hi array<double>, ids binary, x binary, dist binary"
ASKED = "cell int, qb string, q2 double, sure boolean, qlo array<double>, qhi array<double>, qids binary, q binary"


def arrow_schema(fields: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_schema(_parse_datatype_string(fields))


def top_k(df: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank, vec_id, score for every query row (id divisible by ``every``)."""
    rows = usable(df)
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    pivots = farthest_first(stacked([np.array(r.v, dtype=np.float64) for r in picked]), PIVOTS) if picked else np.zeros((0, 1))
    blocks, asked = arrow_schema(BLOCKS), arrow_schema(ASKED)

    def cells(batches):
        for b in batches:
            x = stacked(vectors(b.column(1))) if b.num_rows else np.zeros((0, 1))
            near = distances(x, squared(x), pivots).argmin(1) if len(pivots) else np.zeros(len(x))
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32)), b.column(0), b.column(1)], names=["cell", "vec_id", "v"])

    def candidates(batches):
        for cell, ids, x in packed(batches, BLOCK):
            m2 = float(squared(x).max())
            sure = exact(m2)
            table = pivot_table(x, m2, pivots)[1]
            yield pa.RecordBatch.from_pylist([{
                "cell": cell, "cb": f"{ids[0]}", "n": len(ids), "m2": m2, "sure": sure, "lo": table.min(0) if sure else [], "hi": table.max(0) if sure else [],
                "ids": ids.tobytes(), "x": x.tobytes(), "dist": table.tobytes()}], schema=blocks)

    def queries(batches):
        for cell, ids, x in packed(batches, QUERY_BLOCK):
            q2 = squared(x)
            sure = exact(float(q2.max()))
            near = distances(x, q2, pivots)
            yield pa.RecordBatch.from_pylist([{
                "cell": cell, "qb": f"{ids[0]}", "q2": float(q2.max()), "sure": sure, "qlo": near.min(0) if sure else [], "qhi": near.max(0) if sure else [],
                "qids": ids.tobytes(), "q": x.tobytes()}], schema=asked)

    def each(batches):
        """Of every pair of blocks: its row, and the best of every query."""
        for b in batches:
            for r in range(b.num_rows):
                row = {c: b.column(c)[r].as_py() for c in ("qb", "ids", "x", "dist", "qids", "q", "m2", "least")}
                ids, qids = (np.frombuffer(row[c], dtype=np.int64) for c in ("ids", "qids"))
                x = np.frombuffer(row["x"]).reshape(len(ids), -1)
                table = np.frombuffer(row["dist"]).reshape(len(ids), len(pivots))
                least = np.frombuffer(row["least"]) if row["least"] else np.full(len(qids), -np.inf)
                qs = np.frombuffer(row["q"]).reshape(len(qids), -1)
                yield row["qb"], [(int(i), search(ids, x, row["m2"], pivots, table, int(i), q, k, t)) for i, q, t in zip(qids, qs, least)]

    def thresholds(batches):
        for qb, found in each(batches):
            # a score above 2^53 is not compared as a double
            least = np.array([best[-1][0] if len(best) == k and abs(best[-1][0]) < EXACT else -np.inf for _, best in found], dtype=np.float64)
            yield pa.RecordBatch.from_pydict({"qb": [qb], "least": [least.tobytes()], "least_of_all": [least.min()]})

    def answer(batches):
        for _, found in each(batches):
            flat = [(q, i, s) for q, best in found for s, i in best]
            cols = [pa.array([f[c] for f in flat], pa.int64()) for c in range(3)]
            yield pa.RecordBatch.from_arrays(cols, names=["query_id", "vec_id", "score"])

    placed = stored(rows.mapInArrow(cells, "cell int, vec_id long, v array<double>"), "topk-cells")
    in_order = placed.repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id")
    cand = stored(in_order.mapInArrow(candidates, BLOCKS), "topk-candidates")
    asks = placed.where(F.col("vec_id") % every == 0).repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id")
    ask = stored(asks.mapInArrow(queries, ASKED), "topk-queries")
    home = cand.groupBy("cell").agg(F.max_by("cb", F.struct("n", "cb")).alias("cb")).select("cb")
    first = ask.select("cell", "qb", "qids", "q").join(cand.join(home, "cb").drop("sure"), "cell").withColumn("least", F.lit(None).cast("binary"))
    known = stored(first.mapInArrow(thresholds, "qb string, least binary, least_of_all double"), "topk-thresholds")
    # block ids and spans are paired, once each; the blocks themselves only where a product may reach a threshold
    spans = ask.join(known, "qb").select("qb", "q2", F.col("sure").alias("qsure"), "qlo", "qhi", "least_of_all")
    pairs = spans.crossJoin(cand.select("cb", "m2", "sure", "lo", "hi"))
    apart = F.array_max(F.zip_with(F.zip_with("lo", "qhi", lambda a, b: a - b), F.zip_with("qlo", "hi", lambda a, b: a - b), lambda a, b: F.greatest(a, b)))
    low = F.greatest(F.coalesce(apart, F.lit(0.0)), F.lit(0.0))
    both = F.col("m2") + F.col("q2")
    hopeless = F.col("sure") & F.col("qsure") & ((both - low * low) / 2 + 0.5 + 1e-9 * both < F.col("least_of_all"))
    work = (pairs.where(~hopeless).select("qb", "cb").join(ask.join(known, "qb").select("qb", "qids", "q", "least"), "qb")
            .repartition("qb", "cb").join(cand.select("cb", "m2", "ids", "x", "dist"), "cb"))
    found = work.mapInArrow(answer, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def op2(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
i AS (SELECT vec_id, list_transform(e, lambda x: floor(256 * x)) AS e FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM i q JOIN i c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
