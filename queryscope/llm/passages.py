"""Near-duplicate passages across documents, by compact windows.

A passage is a run of at least ``words`` words; two are near duplicates when
the Jaccard similarity of their five-word shingle sets is at least ``PERCENT``.
For each document the passages that repeat one of an earlier document
(smaller id) are reported, verified on the texts.

Method.  Under one hash function all subsequences of shingles whose minimum
is at position c make one *compact window* (l, c, r): they start in l..c and
end in c..r.  The windows are the nodes of the Cartesian tree over the
hashes; only nodes that span a whole passage are built.  (A node spans one
exactly if it is the minimum of some run of that many shingles, so those
are found by sliding minima and the tree's borders by one stack pass.)
Windows of two documents meet if their minimum is the same.  In each group
of equal minima a window is paired with the group's earliest window of the
same close surroundings, and the first of each surroundings with the
earliest of all, so a group of n copies gives n pairs.  And the windows of the
first function bring a hash of each run of a passage's length with that
minimum, and each run is paired with the earliest equal one, which makes exact
repeats complete.
For each pair of documents the windows of all hash functions are joined by
intervals; stretches on which ``ENOUGH`` of the ``HASHES`` functions agree,
or that have an equal run, are verified shingle by shingle.
The true source may be none of these.  So windows whose runs (of a passage's
length, with the minimum) are equal make a *class*, for which its earliest
document stands: the others repeat that one's runs as they are.  In a group
of up to ``ALL`` classes each meets every earlier one.  In a larger group the
shingles that no verified passage has stay *open*, and each run with open ones
is paired with every earlier class that has three quarters of its shingles and
an open one, found by those that are rarest in the group: neither a text shorter
than a passage that many documents have nor one that is found already brings
these together.  They are verified in turns, the earliest source of each open
place first, until it is in a passage or all its sources were tried.

Cases: null text counts as empty; texts with fewer words than a passage
have none; a null id cannot be named and takes no part; rows that repeat an
id are one document, whose passages are not reported against each other, and
each of its different texts is compared with the other documents' on its own;
an empty table gives no rows; further columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.llm.common import buckets_for, documents, forget, ids_and_texts, per_text, slices, spans, stored, text_or_empty
from queryscope.llm.words import Words, mix, powers, shingles

K = 5
WORDS = 50
PERCENT = 75
HASHES = 4
BUCKETS = 48        # at least; a bucket is sorted in one task
ENOUGH = 2
ALL = 4             # classes of a group that meet in all pairs at once; of larger groups only what stays open
EXACT = HASHES      # stands for a hash function where runs are equal or shingles were counted
HELD = 150_000      # windows a task holds before it sends them
PART = 1000         # windows whose runs, and a quarter of the pairs whose shingles, are looked at together
SEEDS = [np.uint64((i + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1) for i in range(HASHES)]


def sliding_min(v: np.ndarray, t: int) -> np.ndarray:
    """Minimum of v[i:i+t] for every i that has as many."""
    have, m = 1, v
    while have * 2 <= t:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    return np.minimum(m[:len(v) - t + 1], m[t - have:][:len(v) - t + 1]) if have < t else m


def compact_windows(s: np.ndarray, first: np.ndarray, t: int, seed: np.uint64):
    """(text, c, l, r, value) of all compact windows of t shingles or more; positions count from the text's start."""
    if len(s) < t:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z, z.astype(np.uint64)
    v = mix(s ^ seed)
    bits = np.uint64(int(len(s)).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    ranked = (v & ~low) | np.arange(len(s), dtype=np.uint64)  # one order, the leftmost first among equals
    m = sliding_min(ranked, t)
    size = np.diff(first)
    text = np.repeat(np.arange(len(size)), size)
    whole = text[:len(m)] == text[t - 1:]
    m = m[whole]
    m = m[np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))] if len(m) else m
    c = np.unique((m & low).astype(np.int64))
    own = text[c]
    left, right = first[own].tolist(), (first[own + 1] - 1).tolist()
    order, pos, doc = ranked[c].tolist(), c.tolist(), own.tolist()
    stack: list[int] = []
    for i in range(len(pos)):  # borders: the next smaller minimum on either side
        if stack and doc[stack[-1]] != doc[i]:
            stack = []
        while stack and order[stack[-1]] > order[i]:
            right[stack.pop()] = pos[i] - 1
        if stack:
            left[i] = pos[stack[-1]] + 1
        stack.append(i)
    base = first[own]
    return own, c - base, np.array(left, dtype=np.int64) - base, np.array(right, dtype=np.int64) - base, v[c]


def runs_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal neighbours: their id and how many."""
    at = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    return ids[at], np.diff(np.append(at, len(ids))).astype(np.uint32)


def undealt(ids, counts) -> np.ndarray:
    """The ids that ``runs_of`` took together, from Arrow scalars."""
    return np.repeat(np.frombuffer(ids.as_buffer(), dtype=np.int64), np.frombuffer(counts.as_buffer(), dtype=np.uint32))


def in_order(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct units in order, the rank of the document of each, and the place of each of ``units``."""
    order = np.lexsort((units["text"], units["id"]))
    u = units[order]
    new = np.ones(len(u), dtype=bool)
    new[1:] = (u["id"][1:] != u["id"][:-1]) | (u["text"][1:] != u["text"][:-1])
    place = np.empty(len(u), dtype=np.int32)
    place[order] = np.cumsum(new) - 1
    u = u[new]
    other = np.ones(len(u), dtype=bool)
    other[1:] = u["id"][1:] != u["id"][:-1]
    return u, (np.cumsum(other) - 1).astype(np.int32), place


def stretch_hashes(s: np.ndarray):
    """A function (start, end) -> hashes of s[start:end], which do not depend on start."""
    p, inv = powers(len(s) + 1)
    total = np.zeros(len(s) + 1, dtype=np.uint64)
    np.cumsum(mix(s) * p[:len(s)], out=total[1:])
    return lambda start, end: (mix((total[end] - total[start]) * inv[start]) >> np.uint64(32)).astype(np.uint32)


def reach(c: np.ndarray, l: np.ndarray, r: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of the runs of t shingles in l..r that have c."""
    return np.maximum(l, c - t + 1), np.minimum(r, c + t - 1)


def run_starts(w: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """First start, and number, of the runs of t shingles that a window of the first function has; none for the others."""
    c, l, r = (w[k].astype(np.int64) for k in ("c", "l", "r"))
    low = np.maximum(l, c - t + 1)
    return low, np.where(w["hash"] == 0, np.minimum(c, r - t + 1) - low + 1, 0)


def ragged(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places start..start+n-1 of each, one after the other."""
    return np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)


WINDOW = np.dtype([("value", "<u8"), ("around", "<u4"), ("runs", "<u4"), ("c", "<u4"), ("l", "<u4"), ("r", "<u4"), ("hash", "u1")])
#: A text of a document: rows that repeat an id may have different ones.
UNIT = np.dtype([("id", "<i8"), ("text", "<i8")])


def windows(docs: DataFrame, buckets: int, t: int) -> DataFrame:
    """Windows of all documents as packed arrays, dealt out by their minimum."""
    schema = pa.schema([("bucket", pa.int32()), ("windows", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()), ("runs", pa.binary())])

    def send(held):
        w, ids, run = (np.concatenate([h[k] for h in held]) for k in range(3))
        n_runs = run_starts(w, t)[1]
        run_at = np.cumsum(n_runs) - n_runs
        bucket = (w["value"] % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for i in range(buckets):
            part = order[cut[i]:cut[i + 1]]
            if len(part):
                own, n = runs_of(ids[part])
                yield pa.RecordBatch.from_pydict({"bucket": [i], "windows": [w[part].tobytes()], "ids": [own.tobytes()],
                                                  "counts": [n.tobytes()], "runs": [run[ragged(run_at[part], n_runs[part])].tobytes()]}, schema=schema)

    def emit(batches):
        held, n = [], 0
        for b in batches:
            at = 0
            for texts in per_text(b.column(1), 1 << 19):
                ids = np.empty(len(texts), dtype=UNIT)
                ids["id"], ids["text"] = (b.column(k).slice(at, len(texts)).to_numpy() for k in (0, 2))
                at += len(texts)
                s, first = shingles(Words(texts), K)
                hashes = stretch_hashes(s)
                starts = np.arange(max(0, len(s) - t + 1))
                run = hashes(starts, starts + t)
                for j, seed in enumerate(SEEDS):
                    own, c, l, r, v = compact_windows(s, first, t, seed)
                    w = np.zeros(len(c), dtype=WINDOW)
                    w["value"], w["hash"], w["c"], w["l"], w["r"] = v, j, c, l, r
                    at_c = first[own] + c
                    near = s[np.maximum(at_c - K, first[own])], s[np.minimum(at_c + K, first[own + 1] - 1)]  # within the text
                    w["around"] = (mix(near[0] + mix(near[1])) >> np.uint64(32)).astype(np.uint32)
                    low, high = reach(c, l, r, t)
                    w["runs"] = hashes(first[own] + low, first[own] + high + 1) + ((c - low) * 256 + high - low).astype(np.uint32) * np.uint32(0x9E3779B1)
                    low, n_runs = run_starts(w, t)
                    held.append((w, ids[own], run[ragged(first[own] + low, n_runs)]))
                    n += len(w)
                if n >= HELD:
                    yield from send(held)
                    held, n = [], 0
        if n:
            yield from send(held)

    return docs.where("doc_id is not null").select("doc_id", "text", "t").mapInArrow(emit, "bucket int, windows binary, ids binary, counts binary, runs binary")


#: A window (l, r) of a text x, xt and one (l0, r0) of an earlier document's a, at; without a, r0: a window that stays open, and its place c in l0.
PAIR = "x long, xt long, a long, at long, hash int, l int, r int, l0 int, r0 int"


def equal_runs(w: np.ndarray, d: np.ndarray, group: np.ndarray, run: np.ndarray, run_at: np.ndarray, t: int):
    """(window, source window, from, to): starts, counted back from the minimum, of runs that an earlier document has.

    Equal runs have their minimum at the same place, so one place at a time is looked at.
    """
    low, n = run_starts(w, t)
    c = w["c"].astype(np.int64)
    of = np.full(len(w), -1, dtype=np.int64)   # source that goes on from the place before
    since = np.zeros(len(w), dtype=np.int64)
    out = []
    for back in range(t + 1):
        start = c - back
        have = np.flatnonzero((start >= low) & (start < low + n))
        now = np.full(len(w), -1, dtype=np.int64)
        if len(have):
            own = run[run_at[have] + start[have] - low[have]]
            order = np.lexsort((c[have], d[have], own, group[have]))
            have, own = have[order], own[order]
            new = np.ones(len(have), dtype=bool)
            new[1:] = (own[1:] != own[:-1]) | (group[have][1:] != group[have][:-1])
            source = have[np.flatnonzero(new)[np.cumsum(new) - 1]]
            earlier = d[source] < d[have]
            now[have[earlier]] = source[earlier]
        ends = np.flatnonzero((of >= 0) & (now != of))
        out.append((ends, of[ends], since[ends], np.full(len(ends), back - 1)))
        since[now != of] = back
        of = now
    return [np.concatenate(x) for x in zip(*out)]


def meetings(sent: DataFrame, t: int) -> DataFrame:
    """For each window that an earlier document shares: that document and its window; and the classes of large groups."""
    names = [f.split()[0] for f in PAIR.split(", ")]
    schema = pa.schema([(n, pa.int64() if i < 4 else pa.int32()) for i, n in enumerate(names)])

    def pair(table: pa.Table) -> pa.Table:
        w = np.concatenate([np.frombuffer(x.as_buffer(), dtype=WINDOW) for x in table.column("windows")])
        ids = np.concatenate([np.frombuffer(x.as_buffer(), dtype=UNIT) for x in table.column("ids")])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in table.column("counts")])
        run = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in table.column("runs")])
        units, document, place = in_order(ids)
        u = np.repeat(place, counts)
        run_at = run_starts(w, t)[1]
        run_at = np.cumsum(run_at) - run_at
        del ids, counts, place
        order = np.argsort(w["value"])
        v = w["value"][order]
        same = v[1:] == v[:-1]
        often = np.zeros(len(v), dtype=bool)
        often[1:] = same
        often[:-1] |= same
        order = order[often]
        w, u, run_at = w[order], u[order], run_at[order]
        order = np.lexsort((w["c"], u, w["runs"], w["around"], w["value"]))
        w, u, run_at = w[order], u[order], run_at[order]
        n, d = len(w), document[u]
        if n == 0:
            return schema.empty_table()
        new = np.ones(n, dtype=bool)
        new[1:] = w["value"][1:] != w["value"][:-1]
        sub = new.copy()
        sub[1:] |= w["around"][1:] != w["around"][:-1]
        alike = sub.copy()
        alike[1:] |= w["runs"][1:] != w["runs"][:-1]
        group = np.cumsum(new) - 1
        by = np.lexsort((w["c"], u, group))                       # groups keep their place in this order
        earliest = by[np.flatnonzero(new)][group]
        by = np.lexsort((w["c"], u, np.cumsum(sub)))
        start = by[np.flatnonzero(sub)[np.cumsum(sub) - 1]]       # earliest of the same surroundings
        source = np.where(start == np.arange(n), earliest, start)
        first = np.flatnonzero(w["hash"] == 0)
        x, a, least, most = equal_runs(w[first], d[first], group[first], run, run_at[first], t)
        x, a = first[x], first[a]
        equal = [x, a, np.full(len(x), EXACT)]
        for o in (x, a):
            c = w["c"][o].astype(np.int64)
            equal += [c - most, c - least + t - 1]
        # of windows with the same runs those of the earliest document stand for all: its runs are found in the others as they are
        kind = np.cumsum(alike) - 1
        rep = np.flatnonzero(d == d[np.flatnonzero(alike)[kind]])
        once = np.ones(len(rep), dtype=bool)
        once[1:] = (kind[rep[1:]] != kind[rep[:-1]]) | (u[rep[1:]] != u[rep[:-1]])
        one = rep[once]
        l, r = (f.reduceat(w[k][rep], np.flatnonzero(once)) for f, k in ((np.minimum, "l"), (np.maximum, "r")))  # a text may have it several times
        by = np.lexsort((u[one], group[one]))
        one, l, r = one[by], l[by], r[by]
        many = np.bincount(group[one], minlength=group[-1] + 1)
        few = many[group[one]] <= ALL
        one, l, r = one[few], l[few], r[few]
        star = np.flatnonzero(d[source] < d)
        met = [(star, source[star], w["l"][star], w["r"][star], w["l"][source[star]], w["r"][source[star]])]
        for k in range(1, ALL):
            ok = (group[one[k:]] == group[one[:-k]]) & (d[one[:-k]] < d[one[k:]])
            met.append((one[k:][ok], one[:-k][ok], l[k:][ok], r[k:][ok], l[:-k][ok], r[:-k][ok]))
        met = [np.concatenate(m) for m in zip(*met)]
        met.insert(2, w["hash"][met[0]])
        last = np.zeros(group[-1] + 1, dtype=np.int64)
        np.maximum.at(last, group, d)
        sought = d[rep] > d[earliest[rep]]  # the first document of a group is only a source: one place of several is enough
        rest = rep[(many[group[rep]] > ALL) & (last[group[rep]] > d[earliest[rep]]) & (sought | once)]
        cols = [np.concatenate([m, q]) for m, q in zip(met, equal)]
        left = [w["hash"][rest], w["l"][rest], w["r"][rest], w["c"][rest], np.zeros(len(rest))]
        none = pa.nulls(len(rest), pa.int64())
        own, theirs = units[u[np.concatenate([cols[0], rest])]], units[u[cols[1]]]
        return pa.table([*(pa.array(np.ascontiguousarray(own[f])) for f in UNIT.names),
                         *(pa.concat_arrays([pa.array(np.ascontiguousarray(theirs[f])), none]) for f in UNIT.names),
                         *(pa.array(np.concatenate([m, q]).astype(np.int32)) for m, q in zip(cols[2:], left))], schema=schema)

    return sent.groupBy("bucket").applyInArrow(pair, PAIR)


OPEN = np.dtype([("value", "<u8"), ("unit", UNIT), ("first", "?"), ("low", "<u4"), ("size", "<u4"), ("l", "<u4"), ("r", "<u4")])


def bare(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of n shingles no span (from, to; shingles, ends excluded) has."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, spans[:, 0], 1)
    np.add.at(depth, spans[:, 1], -1)
    return np.cumsum(depth[:n]) == 0


def still_open(rest: DataFrame, texts: DataFrame, found: DataFrame, buckets: int, t: int) -> DataFrame:
    """Classes of large groups: the shingles of their runs, and which of these no passage has, dealt out by the minimum."""
    schema = pa.schema([("bucket", pa.int32()), ("windows", pa.binary()), ("shingles", pa.binary()), ("bare", pa.binary())])
    done = found.groupBy("doc_id", F.col("text_hash").alias("t")).agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = texts.join(rest.select(F.col("x").alias("doc_id"), F.col("xt").alias("t"), "ws"), ["doc_id", "t"]).join(done, ["doc_id", "t"], "left")
    width = 2 * t - 1

    def send(held):
        w, s, open_ = (np.concatenate([h[k] for h in held]) for k in range(3))
        bucket = (w["value"] % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for i in range(buckets):
            part = order[cut[i]:cut[i + 1]]
            if len(part):
                yield pa.RecordBatch.from_pydict({"bucket": [i], "windows": [w[part].tobytes()], "shingles": [s[part].tobytes()],
                                                  "bare": [np.packbits(open_[part], axis=1).tobytes()]}, schema=schema)

    def run(batches):
        held, n = [], 0
        for b in batches:
            for i in range(b.num_rows):
                ws, of = b.column(3)[i].values, b.column(4)[i]
                hash_, l, r, c = (ws.field(k).to_numpy().astype(np.int64) for k in range(4))
                s = shingles(Words([b.column(2)[i].as_py()]), K)[0]
                done = np.stack([of.values.field(k).to_numpy() for k in range(2)], axis=1) - [0, K - 1] if of.is_valid else np.zeros((0, 2), dtype=np.int64)
                low, high = reach(c, l, r, t)
                value = mix(s[c] ^ np.array(SEEDS)[hash_])
                kind = mix(value ^ stretch_hashes(s)(low, high + 1)) + ((c - low) * 256 + high - low).astype(np.uint64)
                at = low[:, None] + np.arange(width)
                open_ = bare(done, len(s))[np.minimum(at, len(s) - 1)] & (at <= high[:, None])
                first = np.zeros(len(c), dtype=bool)
                first[np.unique(kind, return_index=True)[1]] = True  # as a source one place of several is enough
                use = np.flatnonzero(first | open_.any(axis=1))
                w = np.zeros(len(use), dtype=OPEN)
                for name, of_ in (("value", value), ("first", first), ("low", low), ("size", high - low + 1), ("l", l), ("r", r)):
                    w[name] = of_[use]
                w["unit"]["id"], w["unit"]["text"] = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                short = (mix(s) >> np.uint64(32)).astype(np.uint32)
                held.append((w, short[np.minimum(at, len(s) - 1)[use]], open_[use]))
                n += len(w)
                if n >= HELD // 4:
                    yield from send(held)
                    held, n = [], 0
        if n:
            yield from send(held)

    return rows.select("doc_id", "t", "text", "ws", "spans").mapInArrow(run, "bucket int, windows binary, shingles binary, bare binary")


def following(token: np.ndarray) -> np.ndarray:
    """Where each token of a row stands next, or beyond the row."""
    n = token.shape[1]
    order = np.argsort(token, axis=1, kind="stable")
    lined = np.take_along_axis(token, order, axis=1)
    after = np.full(token.shape, 2 * n, dtype=np.int64)
    after[:, :-1][lined[:, 1:] == lined[:, :-1]] = order[:, 1:][lined[:, 1:] == lined[:, :-1]]
    out = np.empty_like(after)
    np.put_along_axis(out, order, after, axis=1)
    return out


def in_runs(of: np.ndarray, t: int) -> np.ndarray:
    """(row, run, place in it) of the values of each run of t."""
    return np.lib.stride_tricks.sliding_window_view(of, t, axis=1)


def rare_enough(order: np.ndarray, open_: np.ndarray, size: np.ndarray, last: np.ndarray, t: int) -> np.ndarray:
    """Open places whose shingle is among the rarest of a run's open ones, as many as a passage cannot all do without.

    ``order`` has the shingles of each window in ascending order of frequency,
    ``last`` which place of a run is the last one of its shingle.
    """
    runs = np.sort(np.where(last & in_runs(open_, t), in_runs(order, t), np.iinfo(order.dtype).max), axis=2)
    distinct = last.sum(axis=2)
    own = distinct - -(-distinct * PERCENT // 100)  # so many may be the passage's own: of one more its source has one
    least = np.take_along_axis(runs, own[:, :, None], axis=2)[:, :, 0]
    least[np.arange(t, order.shape[1] + 1) > size[:, None]] = 0
    limit = np.zeros(order.shape, dtype=order.dtype)
    for i in range(least.shape[1]):
        np.maximum(limit[:, i:i + t], least[:, i:i + 1], out=limit[:, i:i + t])
    return open_ & (order <= limit)


def stretch_of(hit: np.ndarray, place: np.ndarray, size: np.ndarray, t: int) -> np.ndarray:
    """For each place with t behind it: the end of the longest stretch from there of t places or more that might be a passage, or 0.

    It begins and ends with a hit unless the window does.  Hits and shingles
    are as many as a similarity of ``PERCENT`` asks for: those of the source
    too, from its first ``place`` to its last, where places ascend (-1 in
    the first column: they are not told).
    """
    width = hit.shape[1]
    out = np.zeros((len(hit), width - t + 1), dtype=np.int64)
    upto = np.zeros((len(hit), width + 1), dtype=np.int32)
    np.cumsum(hit, axis=1, out=upto[:, 1:])
    last = np.maximum.accumulate(np.where(hit, place, -1), axis=1)
    next_ = np.minimum.accumulate(np.where(hit, place, 2 * t)[:, ::-1], axis=1)[:, ::-1]
    told = (place[:, 0] >= 0) & (~hit[:, 1:] | (place[:, 1:] > last[:, :-1])).all(axis=1)
    ends = (hit | (np.arange(width) == size[:, None] - 1)) & (np.arange(width) < size[:, None])
    for p in range(out.shape[1]):
        n = np.arange(t, width - p + 1)
        m = upto[:, p + t:] - upto[:, p:p + 1]
        theirs = np.where(told[:, None], last[:, p + t - 1:] - next_[:, p:p + 1] + 1, m)
        ok = ends[:, p + t - 1:] & ((100 + PERCENT) * m >= PERCENT * (n + np.maximum(m, theirs)))
        if p:
            ok &= hit[:, p:p + 1]
        out[:, p] = np.where(ok.any(axis=1), width - np.argmax(ok[:, ::-1], axis=1), 0)
    return out


def sharing(group: np.ndarray, d: np.ndarray, size: np.ndarray, s: np.ndarray, open_: np.ndarray, source: np.ndarray, t: int):
    """(window, source of an earlier document of its group, open places they share, first and last place to look at).

    They share ``PERCENT`` of a run's shingles, one of them open.

    A passage shares that many with its source, so the source has one of
    those that are rarest in the group, whatever the order of equally rare ones.
    """
    width = 2 * t - 1
    there = np.arange(width) < size[:, None]
    key, of = np.unique(((group.astype(np.uint64)[:, None] << np.uint64(32)) | s)[there], return_inverse=True)
    token = np.full(s.shape, -2, dtype=np.int32)
    token[there] = of
    df = np.bincount(of, minlength=len(key)).astype(np.uint64)
    held = (of.astype(np.uint64) << np.uint64(32)) | np.repeat(d, size).astype(np.uint64)  # the documents of each shingle, in order
    by = np.argsort(held)
    row = np.repeat(np.arange(len(s)), size)[by]
    held, row = held[by][source[row]], row[source[row]]
    none = np.zeros(0, dtype=np.int64)
    out = [(none, none, np.zeros((0, width), dtype=bool), none, none)]
    seekers = np.flatnonzero(open_.any(axis=1))
    seekers = seekers[np.argsort(size[seekers], kind="stable")]
    for i in range(0, len(seekers), PART):
        x = seekers[i:i + PART]
        wide = int(size[x].max())
        places, ends = np.arange(wide), np.arange(t, wide + 1)
        tok = np.where(there[x, :wide], token[x, :wide], -3 - places)
        last = in_runs(following(tok), t) >= ends[:, None]
        distinct = last.sum(axis=2)
        least = -(-distinct * PERCENT // 100)
        any_open = open_[x, :wide]
        again = np.flatnonzero((distinct < t).any(axis=1))  # a shingle is open in all its places or in none
        any_open[again] = ((tok[again][:, :, None] == tok[again][:, None, :]) & any_open[again][:, None, :]).any(axis=2)
        order = np.where(tok >= 0, (df[np.maximum(tok, 0)] << np.uint64(32)) | s[x, :wide], np.iinfo(np.uint64).max)
        of_x, at = np.nonzero(rare_enough(order, any_open, size[x], last, t))
        of_x, look = np.divmod(np.unique(of_x * np.int64(len(key)) + tok[of_x, at]), max(1, len(key)))
        look = look.astype(np.uint64) << np.uint64(32)
        a, z = np.searchsorted(held, look), np.searchsorted(held, look | d[x[of_x]].astype(np.uint64))
        n = z - a
        cut = np.searchsorted(np.cumsum(n), np.arange(0, n.sum(), 1 << 20))
        for b, e in zip(cut, np.append(cut[1:], len(n))):
            near = np.unique((np.repeat(of_x[b:e], n[b:e]).astype(np.int64) << 32) | row[ragged(a[b:e], n[b:e])])
            for j in range(0, len(near), 4 * PART):
                own, other = near[j:j + 4 * PART] >> 32, near[j:j + 4 * PART] & 0xFFFFFFFF
                mine, theirs = tok[own], np.ascontiguousarray(token[other].T)
                hit = np.zeros(mine.shape, dtype=bool)
                for k in range(width):
                    hit |= mine == theirs[k][:, None]
                both, fresh = np.zeros((2, len(own), wide + 1), dtype=np.int16)
                np.cumsum(hit, axis=1, out=both[:, 1:])
                np.cumsum(hit & open_[x[own], :wide], axis=1, out=fresh[:, 1:])
                ok = (both[:, t:] - both[:, :-t] >= least[own]) & (fresh[:, t:] > fresh[:, :-t]) & (ends <= size[x[own]][:, None])
                few = np.flatnonzero(ok.any(axis=1))
                own, other, mine, hit, ok = own[few], other[few], mine[few], hit[few], ok[few]
                same = mine[:, :, None] == token[other][:, None, :]
                place = np.argmax(same, axis=2)
                place[(same.sum(axis=2) > 1).any(axis=1), 0] = -1
                whole = stretch_of(hit, place, size[x[own]], t)
                again = np.flatnonzero((distinct[own] < t).any(axis=1))  # repeated shingles count once
                ok[again] &= (in_runs(hit[again], t) & last[own[again]]).sum(axis=2) >= least[own[again]]
                whole[again] = ok[again] * ends
                whole[~ok.any(axis=1)] = 0
                edge = np.zeros((len(own), wide + 1), dtype=np.int16)
                edge[:, :len(ends)] += whole > 0
                np.add.at(edge, (np.arange(len(own))[:, None], whole), -(whole > 0).astype(np.int16))
                within = np.cumsum(edge[:, :wide], axis=1) > 0
                claim = np.zeros((len(own), width), dtype=bool)
                claim[:, :wide] = hit & open_[x[own], :wide] & within
                ok = claim.any(axis=1)
                out.append((x[own[ok]], other[ok], claim[ok], np.argmax(within[ok], axis=1), wide - 1 - np.argmax(within[ok][:, ::-1], axis=1)))
    return [np.concatenate(y) for y in zip(*out)]


def further_meetings(sent: DataFrame, t: int) -> DataFrame:
    """Of the classes of large groups: those that share enough of a run of a passage's length, some of it in no passage yet.

    x, xt, a, at, ws as of ``together``, and the shared places that are open: claim.
    """
    names = [f.split()[0] for f in PAIR.split(", ")]
    schema = pa.schema([*((n, pa.int64() if i < 4 else pa.int32()) for i, n in enumerate(names)), ("claim", pa.list_(pa.int32()))])
    width = 2 * t - 1

    def pair(table: pa.Table) -> pa.Table:
        w, s, open_ = (np.concatenate([np.frombuffer(x.as_buffer(), dtype=f) for x in table.column(c)])
                       for c, f in (("windows", OPEN), ("shingles", np.uint32), ("bare", np.uint8)))
        units, document, u = in_order(w["unit"])
        x, a, claim, l, r = sharing(np.unique(w["value"], return_inverse=True)[1], document[u], w["size"].astype(np.int64), s.reshape(len(w), width),
                                    np.unpackbits(open_.reshape(len(w), -1), axis=1, count=width).astype(bool), w["first"], t)
        ux, ua = units[u[x]], units[u[a]]
        places = pa.ListArray.from_arrays(spans(claim.sum(axis=1)), pa.array((w["low"][x][:, None] + np.arange(width))[claim].astype(np.int32)))
        return pa.table([*(pa.array(np.ascontiguousarray(z)) for z in (ux["id"], ux["text"], ua["id"], ua["text"], np.full(len(x), EXACT, dtype=np.int32),
                                                                      *(k.astype(np.int32) for k in (w["low"][x] + l, w["low"][x] + r, w["l"][a], w["r"][a])))),
                         places], schema=schema)

    rows = sent.groupBy("bucket").applyInArrow(pair, PAIR + ", claim array<int>")
    return rows.groupBy("x", "xt", "a", "at").agg(F.collect_list(F.struct("hash", "l", "r", "l0", "r0")).alias("ws"),
                                                 F.array_distinct(F.flatten(F.collect_list("claim"))).alias("claim"))


def next_to_try(pairs: DataFrame, found: DataFrame, most: int) -> DataFrame:
    """The pairs of ``further_meetings`` that claim a place still in no passage, and whether it is their turn (``now``).

    It is that of the first ``most`` sources of each such place; a pair that had its turn is not to be given again.
    """
    def choose(mine: pa.Table, spans_: pa.Table) -> pa.Table:
        done = np.stack([spans_.column(k).to_numpy() for k in ("start", "end")], axis=1) - [0, K - 1]
        order = np.lexsort([mine.column(k).to_numpy() for k in ("at", "a")])
        claims = mine.column("claim").combine_chunks()
        upto, places = claims.offsets.to_numpy(), claims.values.to_numpy()
        open_ = bare(done, int(max([1, *places, *done[:, 1:].ravel()])) + 1)
        given, left, now = np.zeros(len(open_), dtype=np.int64), [], []
        for i in order.tolist():
            of = places[upto[i]:upto[i + 1]]
            of = of[open_[of]]
            if len(of):
                left.append(i)
                now.append(bool((given[of] < most).any()))
                given[of] += now[-1]
        return mine.take(pa.array(left, pa.int64())).append_column("now", pa.array(now, pa.bool_()))

    schema = ", ".join(f"{n} {k}" for n, k in pairs.dtypes) + ", now boolean"
    spans_ = found.select(F.col("doc_id").alias("x"), F.col("text_hash").alias("xt"), "start", "end").distinct()
    mine = spans_.join(pairs.select("x", "xt").distinct(), ["x", "xt"], "left_semi")
    return pairs.groupBy("x", "xt").cogroup(mine.groupBy("x", "xt")).applyInArrow(choose, schema)


def enough(hashes: set[int]) -> bool:
    return len(hashes) >= ENOUGH or EXACT in hashes


def stretches(ws: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Interval join of one document pair's windows (hash, l, r, l0, r0): hulls of overlapping ones with enough hashes.

    All hulls that a later window may still meet stay open: windows that point to another place of the source lie between.
    """
    out, still = [], []
    ws = ws[np.lexsort((ws[:, 3], ws[:, 1]))]
    for h, l, r, l0, r0 in ws.tolist():
        hashes, rest, met = {h}, [], True
        for x in still:
            if x[1] >= l:
                rest.append(x)
            elif enough(x[4]):
                out.append(x[:4])
        while met:  # a hull that has grown may meet others
            still, met = rest, False
            rest = []
            for x in still:
                if l <= x[1] and x[0] <= r and l0 <= x[3] and x[2] <= r0:
                    l, r, l0, r0, met = min(l, x[0]), max(r, x[1]), min(l0, x[2]), max(r0, x[3]), True
                    hashes |= x[4]
                else:
                    rest.append(x)
        still = [*rest, (l, r, l0, r0, hashes)]
    return out + [x[:4] for x in still if enough(x[4])]


def trimmed(at: np.ndarray) -> tuple[int, int]:
    """First and last of the matches (ascending positions) without ends that a gap of over three times their matches cuts off."""
    h = 4 * np.arange(len(at)) - at
    low = np.minimum.accumulate(h)
    j = int(np.argmax(h - low))
    return int(np.argmin(h[:j + 1])), j


def longest(at: np.ndarray, per: int) -> tuple[int, int]:
    """First and last match of the longest part with at most one position in between for every ``per`` matches."""
    f = (per + 1) * np.arange(len(at)) - per * at
    top = np.maximum.accumulate(f[::-1])[::-1]
    j = np.searchsorted(-top, 1 - f, side="right") - 1  # the last that is f - 1 or more
    i = int(np.argmax(at[j] - at))
    return i, int(j[i])


def parts(at: np.ndarray) -> list[np.ndarray]:
    """Smaller pieces of matches that do not pass together: off the longest part that might, else off the widest gap."""
    for per in range(3, 7):  # from extra positions on one side to as many on both
        i, j = longest(at, per)
        if (i, j) != (0, len(at) - 1):
            return [at[:i], at[i:j + 1], at[j + 1:]]
    d = np.diff(at)
    k = int(np.argmax(d)) + 1 if len(d) else 0
    return [at[:k], at[k:]] if k and d[k - 1] > 1 else []


def counterpart(own: np.ndarray, a: np.ndarray) -> tuple[int, int, float] | None:
    """The part (ends included) of ``a`` most similar to the set ``own``, and its similarity, if that is ``PERCENT`` or more."""
    best = None
    todo = [np.flatnonzero(np.isin(a, own))]
    while todo:
        at = todo.pop()
        if 100 * len(at) < PERCENT * len(own):  # too few even if nothing else were there
            continue
        passed = False
        i, j = trimmed(at)
        for p, q in {(i, j), (0, len(at) - 1)}:
            other = np.unique(a[at[p]:at[q] + 1])
            both = len(np.intersect1d(own, other, assume_unique=True))
            union = len(own) + len(other) - both
            if 100 * both >= PERCENT * union:
                passed = True
                if best is None or both / union > best[2]:
                    best = int(at[p]), int(at[q]), both / union
        if not passed:
            todo += parts(at)
    return best


def verified(sx: np.ndarray, sa: np.ndarray, hull: tuple[int, int, int, int], t: int) -> list[tuple[int, int, int, int, float]]:
    """Passages (from, to, from0, to0, similarity) in shingle positions, ends included.

    All matches of the hull are tried as one passage, without stray ends
    first, and taken apart only where that misses ``PERCENT``.
    """
    l, r, l0, r0 = hull
    x, a = sx[l:r + 1], sa[l0:r0 + 1]
    out = []
    todo = [np.flatnonzero(np.isin(x, a))]
    while todo:
        run = todo.pop()
        if len(run) == 0 or run[-1] - run[0] + 1 < t:
            continue
        i, j = trimmed(run)
        whole = (0, len(run) - 1)
        for i, j in [(i, j), whole] if (i, j) != whole else [whole]:
            p, q = int(run[i]), int(run[j])
            found = counterpart(np.unique(x[p:q + 1]), a) if q - p + 1 >= t else None
            if found:
                out.append((l + p, l + q, l0 + found[0], l0 + found[1], found[2]))
                todo += [run[:i], run[j + 1:]]
                break
        else:
            todo += parts(run)
    return out


def together(pairs: DataFrame) -> DataFrame:
    """The windows of each two texts."""
    return pairs.groupBy("x", "xt", "a", "at").agg(F.collect_list(F.struct("hash", "l", "r", "l0", "r0")).alias("ws"))


def checked(pairs: DataFrame, texts: DataFrame, t: int) -> DataFrame:
    """The verified passages of pairs of texts."""
    # text of the later document first: one row a text; the earlier one may be a hub, which can be split
    mine = texts.join(pairs.groupBy("x", "xt").agg(F.collect_list(F.struct("a", "at", "ws")).alias("with")),
                      (F.col("doc_id") == F.col("x")) & (F.col("t") == F.col("xt")))
    both = (mine.select("x", "xt", "text", F.explode("with").alias("w"))
            .select("x", "xt", "text", F.col("w.a").alias("a"), F.col("w.at").alias("at"), F.col("w.ws").alias("ws"))
            .join(texts.select(F.col("doc_id").alias("a"), F.col("t").alias("at"), F.col("text").alias("source")), ["a", "at"]))  # the same shuffle again
    names = [f.split()[0] for f in FOUND.split(", ")]
    schema = pa.schema([(n, pa.float64() if n == "similarity" else pa.int64()) for n in names])

    def check(batches):
        for b in batches:
            out: dict = {n: [] for n in names}
            col = {n: b.column(i) for i, n in enumerate(("x", "xt", "a", "at", "text", "source", "ws"))}
            for i in range(b.num_rows):
                ws = col["ws"][i].values
                hulls = stretches(np.stack([ws.field(k).to_numpy() for k in range(5)], axis=1).astype(np.int64))
                if not hulls:
                    continue
                w = Words([col["text"][i].as_py(), col["source"][i].as_py()])
                s, first = shingles(w, K)
                sx, sa = s[:first[1]], s[first[1]:]
                for hull in hulls:
                    for p, q, p0, q0, sim in verified(sx, sa, hull, t):
                        for n, v in zip(names, (col["x"][i].as_py(), p, q + K, col["a"][i].as_py(), p0, q0 + K, sim,
                                                int(w.start[p]), int(w.end[q + K - 1]), col["xt"][i].as_py(), col["at"][i].as_py())):
                            out[n].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return both.select("x", "xt", "a", "at", "text", "source", "ws").mapInArrow(check, FOUND)


FOUND = ("doc_id long, start long, end long, source_id long, source_start long, source_end long, similarity double, from_byte long, to_byte long, "
         "text_hash long, source_hash long")


def repeated_passages(df: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, start, end, source_id, source_start, source_end, similarity, from_byte, to_byte, text_hash, source_hash.

    Word positions, ends excluded; the bytes are those of the UTF-8 text, and
    the hashes (``xxhash64``) tell which texts of repeated ids are meant.
    """
    t = words - K + 1
    docs = ids_and_texts(df, text).withColumn("t", F.xxhash64("text"))
    buckets = buckets_for(docs, BUCKETS)
    several = (F.size(F.array_distinct("ws.hash")) >= ENOUGH) | F.array_contains("ws.hash", EXACT)
    pairs = stored(together(meetings(windows(docs, buckets, t), t)).where(F.col("a").isNull() | several), "passage-pairs")
    each = lambda rows: rows.groupBy("doc_id", "t").agg(F.min("text").alias("text"))
    texts = each(docs.where("doc_id is not null"))
    found = stored(checked(pairs.where("a is not null"), texts, t), "passages")
    further = stored(further_meetings(still_open(pairs.where("a is null"), texts, found, buckets, t), t), "passage-pairs")
    forget(pairs)
    named = further.select(F.col("x").alias("doc_id"), F.col("xt").alias("t")).union(further.select("a", "at")).distinct()
    texts = stored(each(docs.join(named, ["doc_id", "t"], "left_semi")), "passage-texts")
    most = 1
    while True:  # until each open place is in a passage or all its sources were tried
        turn = stored(next_to_try(further, found, most), "passage-pairs")
        forget(further)
        if turn.where("now").isEmpty():
            forget(turn, texts)
            return found.distinct()
        after = stored(found.union(checked(turn.where("now").drop("now", "claim"), texts, t)), "passages")
        further = stored(turn.where("not now").drop("now"), "passage-pairs")
        forget(found, turn)
        found, most = after, 4 * most


def without_passages(df: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without the bytes of ``spans`` (doc_id, text_hash, from_byte, to_byte); other rows and other texts of an id as they are."""
    cut = (spans.groupBy("doc_id", F.col("text_hash").alias("__hash"))
           .agg(F.sort_array(F.collect_set(F.struct("from_byte", "to_byte"))).alias("__cut")))
    joined = (df.withColumn("__hash", F.xxhash64(text_or_empty(text))).join(cut, ["doc_id", "__hash"], "left")
              .select(*[F.col(c) for c in df.columns], "__cut"))
    at, last = df.columns.index(text), len(df.columns)

    def run(batches):
        for b in slices(batches):
            texts = b.column(at).to_pylist()
            for i, spans_ in enumerate(b.column(last).to_pylist()):
                if spans_:
                    raw, out, done = texts[i].encode(), [], 0
                    for s in spans_:
                        out.append(raw[done:max(done, s["from_byte"])])
                        done = max(done, s["to_byte"])
                    texts[i] = b"".join([*out, raw[done:]]).decode("utf-8", "ignore")
            cols = [pa.array(texts, b.schema.field(i).type) if i == at else c for i, c in enumerate(b.columns[:-1])]
            yield pa.RecordBatch.from_arrays(cols, schema=pa.schema(list(b.schema)[:-1]))

    return joined.mapInArrow(run, df.schema)


def op5(spark, sf_dir: str) -> DataFrame:
    return repeated_passages(documents(spark, sf_dir)).drop("text_hash", "source_hash").distinct()
