"""Exact dedup against a minimal perfect hash over the digests of earlier documents.

Texts are equal when they are identical without the characters
``[\\x20\\x09-\\x0D]``; SHA-256 of what is left stands for the text.  Of equal
texts the row with the most code points stays, then that of the smallest id.

Method.  The distinct digests of the history are dealt to shards of about
``SLOTS`` by their own bytes.  Each shard gets a minimal perfect hash: on
every level the digests left are hashed into ``GAMMA`` bits each, a bit that
exactly one of them meets is its place, the others go to the next level; the
rank of a digest's bit among all bits set is its slot.  A slot holds the full
digest and the locator of its winner (row, id, length) with the number of
rows.  A new digest is looked up in its shard: where all bytes equal the
slot's, it is a repeat and joins that group, whose winner may change; all
others are grouped on their own.  Texts are never moved: only digests and
locators are, after one row per digest is left of each task's copies, so
a group of copies of any size is one row in a shard.

Cases: null text counts as empty, and all texts of white space only are
equal; every row counts, also one that repeats an id, and exactly one row of
a group stays; a null id is the last of its length; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from queryscope.llm.common import documents, forget, stored, text_or_empty
from queryscope.llm.words import mix

#: Digests a shard, about; its table of slots is 64 bytes for each.
SLOTS = 1 << 16
#: Bits a digest on each level.
GAMMA = 2
SPACE = " \t\n\x0b\f\r"
GROUP = "digest binary, rank long, turned long, row long, size long"


def fingerprints(df: DataFrame, text: str = "text") -> DataFrame:
    """row (its locator), doc_id, rank, digest, for each row of ``df``.

    rank: twice the code points, plus one where there is an id.
    """
    body, id_ = text_or_empty(text), F.col("doc_id").cast("long")
    return df.select(
        F.monotonically_increasing_id().alias("row"), id_.alias("doc_id"),
        (F.char_length(body).cast("long") * 2 + id_.isNotNull().cast("long")).alias("rank"),
        F.unhex(F.sha2(F.translate(body, SPACE, ""), 256)).alias("digest"))


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: rank, turned id and row of the one that stays, number of rows."""
    best = F.max(F.struct("rank", F.coalesce(F.bitwise_not("doc_id"), F.lit(0)).alias("turned"), F.bitwise_not("row").alias("row")))
    return (rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("size"))
            .select("digest", "best.rank", "best.turned", "best.row", "size"))


def four_bytes(at: int) -> Column:
    return F.conv(F.hex(F.substring("digest", at, 4)), 16, 10).cast("long")


def as_words(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype="<u8").reshape(-1, 4)


def places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    h = np.full(len(words), np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1))
    for i in range(4):
        h = mix(h ^ words[:, i])
    return (h % np.uint64(size)).astype(np.int64)


def perfect_hash(words: np.ndarray) -> list[np.ndarray]:
    """The bits of each level; ``words``: distinct digests."""
    levels, left = [], np.arange(len(words))
    while len(left):
        size = -(-GAMMA * len(left) // 64) * 64
        at = places(words[left], len(levels), size)
        met = np.bincount(at, minlength=size)
        levels.append(met == 1)
        left = left[met[at] > 1]
    return levels


def slots_of(words: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Slot of each digest; that of a digest outside the hashed set is any, or -1."""
    slot, left, base = np.full(len(words), -1, dtype=np.int64), np.arange(len(words)), 0
    for level, bits in enumerate(levels):
        at = places(words[left], level, len(bits))
        hit = bits[at]
        rank = np.cumsum(bits)
        slot[left[hit]] = base + rank[at[hit]] - 1
        base += int(rank[-1])
        left = left[~hit]
    return slot


def columns(table: pa.Table) -> tuple[bytes, np.ndarray]:
    """Digests, joined, and (rank, turned, row, size) of a table of groups."""
    values = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("rank", "turned", "row", "size")], axis=1)
    return b"".join(table.column("digest").to_pylist()), values


def build(groups: DataFrame, shards: int) -> DataFrame:
    """The index: shard, sizes and bits of its levels, digests and values by slot."""
    schema = pa.schema([("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()),
                        ("digests", pa.binary()), ("held", pa.binary())])

    def make(key, table):
        raw, values = columns(table)
        words = as_words(raw)
        levels = perfect_hash(words)
        order = np.argsort(slots_of(words, levels))
        bits = np.packbits(np.concatenate(levels)).tobytes()
        return pa.Table.from_pydict({"shard": [key[0].as_py()], "sizes": [[len(x) for x in levels]], "bits": [bits],
                                     "digests": [words[order].tobytes()], "held": [values[order].tobytes()]}, schema=schema)

    return groups.withColumn("shard", four_bytes(5) % shards).groupBy("shard").applyInArrow(
        make, "shard long, sizes array<long>, bits binary, digests binary, held binary")


def merged(index: DataFrame, groups: DataFrame, shards: int, parts: int = 1) -> DataFrame:
    """All groups after the new ones are looked up: digest, rank, turned, row, size, known (a slot of the index).

    A shard's new digests are read in ``parts`` tasks, each of which has the shard's slots.
    """
    schema = pa.schema([("digest", pa.binary()), *[(c, pa.int64()) for c in ("rank", "turned", "row", "size")], ("known", pa.bool_())])

    def out(words, values, known):
        return pa.table([pa.array([w.tobytes() for w in words], pa.binary()), *[pa.array(values[:, i]) for i in range(4)],
                         pa.array(np.full(len(words), known))], schema=schema)

    def look_up(key, shard, new):
        raw, values = columns(new)
        words = as_words(raw)
        if not shard.num_rows:
            return out(words, values, False)
        one = {c: shard.column(c)[0].as_py() for c in ("sizes", "bits", "digests", "held")}
        cut = np.cumsum(one["sizes"])
        bits = np.unpackbits(np.frombuffer(one["bits"], dtype=np.uint8))[:cut[-1]].astype(bool)
        old, held = as_words(one["digests"]), np.frombuffer(one["held"], dtype=np.int64).reshape(-1, 4).copy()
        slot = slots_of(words, np.split(bits, cut[:-1]))
        member = slot >= 0
        member[member] = (old[slot[member]] == words[member]).all(axis=1)  # all bytes of the digest
        at, mine = slot[member], values[member]
        now = held[at]
        better = np.zeros(len(at), dtype=bool)
        for i in (2, 1, 0):
            better = (mine[:, i] > now[:, i]) | ((mine[:, i] == now[:, i]) & better)
        size = now[:, 3] + mine[:, 3]
        now[better] = mine[better]
        now[:, 3] = size
        held[at] = now
        first = old.view(np.uint8).reshape(-1, 32)[:, :4].copy().view(">u4").ravel()
        here = first % np.uint32(parts) == key[1].as_py()
        return pa.concat_tables([out(old[here], held[here], True), out(words[~member], values[~member], False)])

    slots = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    new = groups.withColumn("shard", four_bytes(5) % shards).withColumn("part", four_bytes(1) % parts)
    return (slots.groupBy("shard", "part").cogroup(new.groupBy("shard", "part")).applyInArrow(look_up, GROUP + ", known boolean"))


def deduplicate(df: DataFrame, history: Column, text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, known for each row of ``df``.

    ``history``: the rows delivered earlier, over doc_id; the index is made of
    their digests, and the digests of all others are looked up in it.
    """
    rows = stored(fingerprints(df, text).withColumn("earlier", F.coalesce(history, F.lit(False))), "dedup-rows")
    n = {r.earlier: r.n for r in rows.groupBy("earlier").agg(F.approx_count_distinct("digest").alias("n")).collect()}
    shards = 1 + n.get(True, 0) // SLOTS
    parts = 1 + n.get(False, 0) // (SLOTS * shards)
    index = stored(build(winners(rows.where("earlier")), shards), "dedup-index")
    groups = stored(merged(index, winners(rows.where("not earlier")), shards, parts), "dedup-groups")
    forget(index)
    named = groups.select("digest", F.when(F.col("rank") % 2 == 1, F.bitwise_not("turned")).alias("keep_id"),
                          F.bitwise_not("row").alias("keep"), F.col("size").alias("group_size"), "known")
    return rows.join(named, "digest").select(  # rows of a frequent digest are split by the skew join
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "known")


def op12(spark, sf_dir: str) -> DataFrame:
    """The documents of the lower half of the ids are the history, all others come after them."""
    docs = documents(spark, sf_dir)
    ends = docs.agg(F.min("doc_id").cast("decimal(38,0)").alias("lo"), F.max("doc_id").cast("decimal(38,0)").alias("hi")).first()
    middle = 0 if ends.lo is None else int((ends.lo + ends.hi) // 2)
    return deduplicate(docs, F.col("doc_id") <= middle).drop("known")


OP12_SQL = """
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, row_number() OVER () AS r,
    sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS h FROM documents),
o AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST, r) AS k FROM t)
SELECT doc_id, first_value(doc_id) OVER (PARTITION BY h ORDER BY k) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  k = 1 AS kept, h AS text_sha256 FROM o
"""
