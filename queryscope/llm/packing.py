"""Packing of tokenised documents into fixed-length sequences by column generation.

A document's ids are cut into whole sequences and one rest; the rests are
packed as a cutting-stock problem over their length histogram, which has at
most ``size`` rows however many documents there are:

1. *Linear program.*  Minimise the number of sequences over patterns (how
   many rests of each length share one) so that every length's demand is
   met.  A greedy filling gives the first basis, one pattern per length.
   Columns are generated on demand: a knapsack program over the
   capacity finds the pattern worth most at the present dual prices; it
   enters the basis while it is worth more than a sequence.  Pricing stops
   at optimality, at ``GAP`` from the lower bound, or after ``ROUNDS``.
2. *Rounding.*  Each full pattern is used its whole number of times.  What
   does not come into play by that (less than one sequence per basic
   pattern) is packed by knapsacks over what is left.  The rests of patterns
   and of sequences that stay short are cut: many equal sequences at a time
   get a head of one length and are filled up with whole rests or pieces of
   another, whose remainders are rests again.  The last ids go to sequences
   of powers of two, which need no padding.
3. *Assignment.*  The rests of one length are ranked (by id within salted
   shares, so a length that a third of all rows have is spread) and each
   pattern takes a range of ranks of every length in it.

The driver sees the histogram only; the plan it sends back has a row for
each (pattern, length), bounded by ``size`` squared, however many rests there are.

Cases: null text counts as empty, so the document is its final id alone;
rows without an id are packed like others; repeated rows are packed each;
very long texts give many pieces; an empty table gives no rows; further
columns of the input are left out.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from queryscope.llm.common import documents, forget, per_text, stored, text_or_empty, tokenizer_file

SIZE = 1024
SALTS = 128
GAP = 1e-3
ROUNDS = 300
#: A pattern is full when no more than size / SPARE ids are missing.
SPARE = 128
END = 0  # the id after every document


# ------------------------------------------------------------------ the plan

def knapsack(lengths: np.ndarray, worth: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c] of an unbounded knapsack and the item taken last at c (-1: none)."""
    best = np.zeros(size + 1)
    last = np.full(size + 1, -1)
    order = np.argsort(lengths)
    ls, ws = lengths[order], worth[order]
    upto = np.searchsorted(ls, np.arange(size + 1), side="right")
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if k := upto[c]:
            v = ws[:k] + best[c - ls[:k]]
            i = int(v.argmax())
            if v[i] > best[c]:
                best[c], last[c] = v[i], order[i]
    return best, last


def pattern_of(lengths: np.ndarray, last: np.ndarray, size: int) -> np.ndarray:
    a = np.zeros(len(lengths))
    c = size
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            a[last[c]] += 1
            c -= lengths[last[c]]
    return a


def fill(room: int, have: np.ndarray) -> list[int]:
    """Lengths that fill ``room``: one exactly, two exactly, or the largest that fits and so on.

    have[l] is the demand left of length l.  Of the exact pairs, the one
    whose scarcer length is most plentiful is taken.
    """
    out: list[int] = []
    while room > 0:
        if have[room] > 0:
            return [*out, room]
        small = np.arange(1, room // 2 + 1)
        scarce = np.minimum(have[small], have[room - small])
        if len(small) and scarce.max() > 0:
            i = int(small[scarce.argmax()])
            return [*out, room - i, i]
        fits = np.flatnonzero(have[:room] > 0)
        if not len(fits):
            return out
        out.append(int(fits[-1]))
        room -= out[-1]
    return out


def first_basis(lengths: np.ndarray, demand: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A feasible basis: the longest length left is filled up, and the pattern used until one of its lengths is spent.

    Later patterns lack the spent lengths, so the columns are triangular
    in that order and make a basis.
    """
    m = len(lengths)
    row = {int(l): i for i, l in enumerate(lengths)}
    have = np.zeros(size + 1)
    have[lengths] = demand
    cols, x = np.zeros((m, m)), np.zeros(m)
    for _ in range(m):
        l = int(np.flatnonzero(have > 0)[-1])
        a = np.bincount([l, *fill(size - l, have)], minlength=size + 1)
        on = np.flatnonzero(a)
        times = have[on] / a[on]
        out = int(on[times.argmin()])
        j = row[out]
        cols[:, j], x[j] = a[lengths], times.min()
        have[on] = np.maximum(have[on] - times.min() * a[on], 1e-12)
        have[out] = 0
    return cols, x


def column_generation(lengths: np.ndarray, demand: np.ndarray, size: int, rounds: int = ROUNDS, gap: float = GAP):
    """Basic patterns (columns) and how often each is used in the linear program."""
    cols, x = first_basis(lengths, demand, size)
    inv = np.linalg.inv(cols)
    y = inv.sum(0)
    floor = float(lengths @ demand) / size
    for _ in range(rounds):
        if x.sum() <= floor * (1 + gap):
            break
        best, last = knapsack(lengths, np.maximum(y, 0), size)
        if best[size] <= 1 + 1e-9 or x.sum() <= float(np.maximum(y, 0) @ demand) / best[size] * (1 + gap):
            break
        a = pattern_of(lengths, last, size)
        a[y < 0] = 0
        d = inv @ a
        at = np.flatnonzero(d > 1e-9)
        if not len(at):
            break
        r = at[np.argmin(x[at] / d[at])]
        step = x[r] / d[r]
        gain = 1.0 - float(y @ a)
        x -= step * d
        x[r] = step
        np.maximum(x, 0, out=x)
        row = inv[r] / d[r]
        inv -= np.outer(d, row)
        inv[r] = row
        y += gain * row
        cols[:, r] = a
    return cols, x


def leftover(count: dict[int, int], size: int) -> list[list[int]]:
    """Sequences of whole rests, each filled from the longest rest left on."""
    out = []
    have = np.zeros(size + 1, dtype=np.int64)
    for l, n in count.items():
        have[l] = n
    while have.any():
        l = int(np.flatnonzero(have)[-1])
        seq, room = [l], size - l
        have[l] -= 1
        while room:
            more = fill(room, have)
            if not more:
                break
            # one at a time: a pair of equal lengths needs two
            l = more[0]
            have[l] -= 1
            seq.append(l)
            room -= l
        out.append(seq)
    return out


class Run:
    """Equal pieces of a range of ranks of one length: ``size`` ids from ``start`` on of ``n`` rests from rank ``first`` on."""

    def __init__(self, length: int, first: int, n: int, start: int, size: int):
        self.length, self.first, self.n, self.start, self.size = length, first, n, start, size

    def place(self, sequences: int, per: int, seq: int, offset: int, size: int) -> tuple[tuple, Run | None]:
        """The plan's row for the first ``size`` ids of ``per`` pieces a sequence, and the run of what remains of them."""
        row = (self.length, self.first, sequences * per, per, seq, offset, self.start, size)
        rest = Run(self.length, self.first, sequences, self.start + size, self.size - size) if size < self.size else None
        self.first += sequences * per
        self.n -= sequences * per
        return row, rest


def filled_up(runs: list[Run], size: int, seq: int) -> list[tuple]:
    """Plan of sequences that all are full; rests are cut where they do not fit, the last sequences are powers of two."""
    out: list[tuple] = []
    total = sum(r.n * r.size for r in runs)
    while total:
        if total < size:
            size = 1 << total.bit_length() - 1
        most, offset, parts = total // size, 0, []
        left = {id(r): r.n for r in runs}
        while offset < size:  # what each of ``most`` equal sequences holds
            room = size - offset
            enough = [r for r in runs if left[id(r)] >= most]
            if not enough:  # fewer sequences at a time
                most = max(left.values())
                offset, parts, left = 0, [], {id(r): r.n for r in runs}
                continue
            whole = [r for r in enough if r.size <= room]
            r = max(whole or enough, key=lambda r: (r.size, left[id(r)]))
            per = min(room // r.size, left[id(r)] // most) if whole else 1
            piece = min(room, r.size)
            parts.append((r, per, offset, piece))
            left[id(r)] -= per * most
            offset += per * piece
        for r, per, at, piece in parts:
            row, rest = r.place(most, per, seq, at, piece)
            out.append(row)
            if rest:
                runs.append(rest)
        runs = [r for r in runs if r.n]
        seq += most
        total -= most * size
    return out


def plan(histogram: dict[int, int], size: int = SIZE) -> list[tuple]:
    """(length, from_rank, ranks, per_sequence, sequence, offset, piece_start, piece_length).

    Ranks from_rank .. from_rank + ranks - 1 of a length go to sequences
    from ``sequence`` on, ``per_sequence`` each, from ``offset`` on; the
    piece is ``piece_length`` ids from ``piece_start`` on within the rest.
    """
    used = dict.fromkeys(histogram, 0)
    out: list[tuple] = []
    seq = 0
    if n := histogram.get(size):
        out.append((size, 0, n, 1, 0, 0, 0, size))
        seq = n
    lengths = np.array(sorted(l for l in histogram if l < size and histogram[l]), dtype=int)
    rest = {int(l): histogram[int(l)] for l in lengths}
    cut = dict.fromkeys(rest, 0)
    if len(lengths):
        demand = np.array([float(rest[int(l)]) for l in lengths])
        cols, x = column_generation(lengths, demand, size)
        for j in np.argsort(-x, kind="stable"):
            items = [(int(lengths[i]), int(cols[i, j])) for i in np.flatnonzero(cols[:, j])]
            times = min([int(x[j] + 1e-6), *(rest[l] // k for l, k in items)])
            if times <= 0:
                continue
            full = sum(l * k for l, k in items) >= size - size // SPARE
            offset = 0
            for l, k in items:
                rest[l] -= times * k
                if full:
                    out.append((l, used[l], times * k, k, seq, offset, 0, l))
                    used[l] += times * k
                    offset += l * k
                else:
                    cut[l] += times * k
            seq += times if full else 0
    for s in leftover(rest, size):
        if sum(s) < size - size // SPARE:
            for l in s:
                cut[l] += 1
            continue
        offset = 0
        for l in s:
            out.append((l, used[l], 1, 1, seq, offset, 0, l))
            used[l] += 1
            offset += l
        seq += 1
    return out + filled_up([Run(l, used[l], n, 0, l) for l, n in cut.items() if n], size, seq)


# ------------------------------------------------------------------ the jobs

def encoder(ranks_file: str):
    """Byte-level BPE from its rank file; equal ids to the JSON form of the vocabulary (tested), in a fifth of the time."""
    import public_tokenizers
    import tiktoken
    with open(ranks_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={"<|endoftext|>": len(ranks)})


def tokenised(batches, column: int, ranks_file: str):
    enc = encoder(ranks_file)
    for b in batches:
        at = 0
        for texts in per_text(b.column(column), 1 << 20):
            part = b.slice(at, len(texts))
            at += len(texts)
            yield part, [np.append(np.array(enc.encode(t, allowed_special="all"), dtype="<u4"), np.uint32(END)).astype("<u4")
                         for t in texts]


PIECES = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, ranks_file: str, size: int) -> DataFrame:
    """Whole sequences and rests of every document; ``row`` tells repeated rows of one document apart."""
    def cut(batches):
        for part, ids in tokenised(batches, 2, ranks_file):
            out: dict = {c.split()[0]: [] for c in PIECES.split(", ")}
            for d, r, x in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), ids):
                for s in range(0, len(x), size):
                    p = x[s:s + size]
                    for c, v in zip(out, (d, r, s, len(p), zlib.crc32(p.tobytes()), len(x))):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    return docs.select("doc_id", "row", "text").mapInArrow(cut, PIECES)


def ranked(df: DataFrame) -> DataFrame:
    """``df`` with ``rank`` from 0 within each length, counted in salted shares."""
    salted = df.withColumn("salt", F.pmod(F.xxhash64("doc_id", "row", "start"), F.lit(SALTS)).cast("int"))
    shares = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    w = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = shares.select("length", "salt", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "row", "start")
    # at most size * SALTS rows
    return (salted.withColumn("own", F.row_number().over(own) - 1)
            .join(F.broadcast(before), ["length", "salt"])
            .withColumn("rank", F.col("before") + F.col("own")).drop("salt", "own", "before"))


def pack(docs: DataFrame, ranks_file: str, size: int = SIZE, text: str = "text") -> DataFrame:
    """Pieces of all documents with sequence_id and offset, and ``row``."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(text).alias("text")) \
        .withColumn("row", F.xxhash64("doc_id", "text"))
    cut = stored(pieces(rows, ranks_file, size), "pack-pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most size rows
    steps = plan(histogram, size)
    schema = ("length long, from_rank long, ranks long, per_sequence long, sequence long, "
              "at long, piece_start long, piece_length long")
    step = spark.createDataFrame(steps, schema)
    placed = (ranked(cut).join(F.broadcast(step), "length")
              .where((F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("from_rank") + F.col("ranks")))
              .withColumn("k", F.col("rank") - F.col("from_rank"))
              .select("doc_id", "row", (F.col("start") + F.col("piece_start")).alias("start"),
                      F.col("piece_length").alias("length"),
                      F.when(F.col("piece_length") == F.col("length"), F.col("ids_crc32")).alias("ids_crc32"), "doc_tokens",
                      (F.col("sequence") + F.expr("k div per_sequence")).alias("sequence_id"),
                      (F.col("at") + F.expr("k % per_sequence") * F.col("piece_length")).alias("offset")))
    placed = stored(placed, "pack-placed")
    forget(cut)
    # rests that were cut are read again for their checksums
    split = placed.where(F.col("ids_crc32").isNull())
    again = (rows.join(split.groupBy("row").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("cuts")), "row")
             .dropDuplicates(["row"]).select("row", "text", "cuts"))

    def sums(batches):
        for part, ids in tokenised(batches, 1, ranks_file):
            out: dict = {c: [] for c in ("row", "start", "length", "crc")}
            for r, x, cuts in zip(part.column(0).to_pylist(), ids, part.column(2).to_pylist()):
                for c in cuts:
                    p = x[c["start"]:c["start"] + c["length"]]
                    for k, v in zip(out, (r, c["start"], c["length"], zlib.crc32(p.tobytes()))):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    crc = again.mapInArrow(sums, "row long, start long, length long, crc long")
    whole = placed.where(F.col("ids_crc32").isNotNull())
    key = ["row", "start", "length"]
    mended = split.drop("ids_crc32").join(crc, key).withColumnRenamed("crc", "ids_crc32")
    return whole.unionByName(mended)


def op1(spark, sf_dir: str, ranks_file: str | None = None) -> DataFrame:
    out = pack(documents(spark, sf_dir), ranks_file or tokenizer_file("byte_bpe_50k.tiktoken"))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
