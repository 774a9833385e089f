"""Cheapest repair of conversations by tables over blocks of turns (Four Russians).

A repaired conversation's role initials read ``(s?(ua)+)?``: four states
(nothing yet, after s, after u, after a) and, for each edit letter, one state
to go to.  A turn is kept (0), given the role that is due (2) or deleted (3);
an empty turn of the role that is due may be inserted anywhere (2).  Blank and
duplicate turns must be deleted; a truncated turn that stays costs 1 more.

Method.  The cost to go from each state to the end is a vector of four
numbers; with its least taken off, only few vectors exist.  For every block
of ``BLOCK`` symbols and every such vector a table holds the vector before
the block and the cost taken off.  A conversation is read from its end, one
lookup a block.  The edits are then traced from the front: a block is
expanded backward from the vector at its right border, and in each turn the
ASCII-least letter that keeps the optimum is taken.  A letter leads to one
state only, so this gives the least of all cheapest edit strings.

Data.  Of the texts, only digests are ordered: rows of one conversation, turn,
role and text are counted first, the rest is sorted by ranges (a long
conversation lies in many tasks), and a conversation's symbols are put
together page by page to one string, as long as its edit string in the
result.  The texts are shuffled once, by conversation, and hashed in order as
they stream by, since SHA-256 is sequential; no task holds a conversation.

Cases: null role or text is one space (so is a null id or turn in the
checksum that deals out the damage); a role other than s…, u…, a… is never
kept; null turns come first; rows of one turn are ordered by the SHA-256 of
their role and text, after which equal rows are copies; a null
conversation id is one conversation; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queryscope.llm.common import stored

BLOCK = 4
#: Rows a page of symbols, a power of two.
PAGE_BITS = 12
INITIALS = "sua"
#: Fault classes of a row; the symbol of a row is its class and initial, as a letter from "a" on.
WHOLE, TRUNCATED, BLANK, DUPLICATE = range(4)
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
START, AFTER_S, AFTER_U, AFTER_A = range(4)
#: State after the role that is due is added, and that role.
DUE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
ROLE = ("user", "user", "assistant", "user")
LEGAL = ("su", "ua", "au")
END = (0, 2 * INSERT, INSERT, 0)


def kept_state(state: int, initial: int) -> int | None:
    """State after a turn of this initial (0 s, 1 u, 2 a, 3 other) is kept, if it may stand here."""
    if initial == 0:
        return AFTER_S if state == START else None
    return DUE[state] if initial < 3 and ROLE[state][0] == INITIALS[initial] else None


def before(after: tuple, symbol: int) -> tuple[list, list]:
    """Cost to go in front of a turn from that behind it, and the options (letter, cost, state, behind the turn?) of each state."""
    fault, initial = divmod(symbol, 4)
    options = []
    for s in range(4):
        o = [("D", DELETE, s, True), ("I", INSERT, DUE[s], False)]
        if fault < BLANK:
            to = kept_state(s, initial)
            o += [("K", KEEP + fault, to, True)] if to is not None else []
            o.append(("R", REROLE + fault, DUE[s], True))
        options.append(o)
    cost = [min(c + after[t] for _, c, t, done in o if done) for o in options]
    for _ in range(4):
        cost = [min(c, INSERT + cost[DUE[s]]) for s, c in enumerate(cost)]
    return cost, options


class Tables:
    """Vectors, transitions of single symbols and of blocks, and the edits of each step."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [END]
        known = {END: 0}
        to, off, self.steps = [], [], []
        for v in self.vectors:  # grows
            rows = []
            for symbol in range(16):
                cost, options = before(v, symbol)
                least = min(cost)
                n = tuple(c - least for c in cost)
                if n not in known:
                    known[n] = len(self.vectors)
                    self.vectors.append(n)
                rows.append((known[n], least))
                self.steps.append([self.edits(s, v, cost, options) for s in range(4)])
            to.append([a for a, _ in rows])
            off.append([b for _, b in rows])
        self.to, self.off = np.array(to).T.copy(), np.array(off).T.copy()  # by symbol, vector
        blocks_to, blocks_off = self.to, self.off
        for _ in range(block - 1):  # one symbol more in front
            blocks_off = (blocks_off[None, :, :] + self.off[:, blocks_to]).reshape(-1, len(to))
            blocks_to = self.to[:, blocks_to].reshape(-1, len(to))
        self.blocks_to, self.blocks_off = blocks_to, blocks_off

    @staticmethod
    def edits(state: int, after: tuple, cost: list, options: list) -> tuple[str, int]:
        """Least letters up to the turn's own, and the state behind it."""
        out = ""
        while True:
            for letter, c, t, done in options[state]:  # in ASCII order
                if cost[state] == c + (after[t] if done else cost[t]):
                    out, state = out + letter, t
                    if done:
                        return out, state
                    break

    def repair(self, symbols: np.ndarray) -> tuple[int, str]:
        """Least cost and its least edit string."""
        lead = len(symbols) % self.block
        blocks = symbols[lead:].reshape(-1, self.block).astype(np.int64) @ (16 ** np.arange(self.block - 1, -1, -1))
        border, cost, v = [0] * (len(blocks) + 1), 0, 0
        for i in range(len(blocks) - 1, -1, -1):
            cost += int(self.blocks_off[blocks[i], v])
            v = int(self.blocks_to[blocks[i], v])
            border[i] = v
        out, state, total = [], START, None
        for i in range(-1, len(blocks)):
            part = symbols[:lead] if i < 0 else symbols[lead + i * self.block:lead + (i + 1) * self.block]
            v, right = border[i + 1], []
            for s in part[::-1].tolist():
                right.append((s, v))
                if i < 0:
                    cost += int(self.off[s, v])
                v = int(self.to[s, v])
            total = cost + self.vectors[v][START] if total is None else total
            for s, v in reversed(right):
                letters, state = self.steps[v * 16 + s][state]
                out.append(letters)
        while state in (AFTER_S, AFTER_U):
            out.append("I")
            state = DUE[state]
        return total, "".join(out)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n (copies): the rows as the damage leaves them, text null where it drops them."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat_ws(":", *shown)) % 20
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role").cast("string"), F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).when(kind != 0, text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("n"))


def ordered(rows: DataFrame) -> DataFrame:
    """conv_id, turn, key, n, symbol parts and ``at``, the place of each distinct row in the order of all."""
    at_end = F.right(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), F.lit(1))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    fault = F.when(at_end == "", BLANK).when(at_end.isin(".", "!", "?"), WHOLE).otherwise(TRUNCATED)
    once = (rows.select("conv_id", "turn", "key", "n", initial.alias("initial"), fault.alias("fault"))
            .groupBy("conv_id", "turn", "key").agg(F.sum("n").alias("n"), F.min("initial").alias("initial"), F.min("fault").alias("fault")))
    order = ("conv_id", "turn", "key")
    return once.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())


def symbols(places: DataFrame) -> DataFrame:
    """conv_id, symbols: a letter for each row, in order."""
    def letter(fault):
        return F.char((fault * 4 + F.col("initial") + ord("a")).cast("long"))

    first = places.groupBy("conv_id", "key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    own = F.when((F.col("fault") == BLANK) | F.col("new"), F.col("fault")).otherwise(DUPLICATE)
    more = F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE)
    rows = places.join(first, "at", "left").select(
        "conv_id", "at", F.concat(letter(own), F.repeat(letter(more), (F.col("n") - 1).cast("int"))).alias("s"))

    def together(grouped, order):
        return grouped.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, "s"))), lambda x: x["s"]), "").alias("s"))

    pages = together(rows.groupBy("conv_id", F.shiftright("at", PAGE_BITS).alias("page")), "at")
    return together(pages.groupBy("conv_id"), "page").withColumnRenamed("s", "symbols")


HEAD = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def repaired(strings: DataFrame) -> DataFrame:
    """The strings of symbols with their counts, cost and edits."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string
    out = StructType(strings.drop("symbols").schema.fields + _parse_datatype_string(HEAD).fields)
    arrow = to_arrow_schema(out)
    at = strings.columns.index("symbols")
    legal = np.zeros(16, dtype=bool)
    legal[[INITIALS.index(a) * 4 + INITIALS.index(b) for a, b in LEGAL]] = True

    def one(tables: Tables, text: str | None):
        s = np.frombuffer((text or "").encode(), dtype=np.uint8) - ord("a")
        n = np.bincount(s // 4, minlength=4)
        pairs = s[:-1] % 4 * 4 + s[1:] % 4
        return int(n[BLANK]), int(n[DUPLICATE]), int(n[TRUNCATED]), int((~legal[pairs]).sum()), *tables.repair(s)

    def run(batches):
        tables = Tables()
        for b in batches:
            rows = [one(tables, x.as_py()) for x in b.column(at)]
            kept = [c.cast(arrow.field(i).type) for i, c in enumerate(c for j, c in enumerate(b.columns) if j != at)]
            extra = [pa.array(list(c), arrow.field(len(kept) + i).type) for i, c in enumerate(zip(*rows))] if rows else [
                pa.array([], f.type) for f in list(arrow)[len(kept):]]
            yield pa.RecordBatch.from_arrays(kept + extra, schema=arrow)

    return strings.mapInArrow(run, out)


class Hasher:
    """The repaired conversation's hash, turn by turn."""

    def __init__(self, audit: str):
        self.letters, self.state, self.sha, self.empty = iter(audit), START, hashlib.sha256(), True

    def add(self, role: str, text: str) -> None:
        self.sha.update((("" if self.empty else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.empty = False

    def insert(self) -> None:
        self.add(ROLE[self.state], "")
        self.state = DUE[self.state]

    def turn(self, role: str, text: str) -> None:
        for letter in self.letters:
            if letter == "I":
                self.insert()
                continue
            if letter == "K":
                self.add(role, text)
                self.state = kept_state(self.state, INITIALS.find(role[0]))
            elif letter == "R":
                self.add(ROLE[self.state], text)
                self.state = DUE[self.state]
            return

    def done(self) -> str:
        for _ in self.letters:
            self.insert()
        return self.sha.hexdigest()


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    every = damaged(conversations)
    text_key = F.sha2(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text"), 256)
    rows = every.where("text is not null").withColumn("key", F.unhex(text_key))
    turns = every.groupBy("conv_id", "turn").agg(F.max(F.col("text").isNotNull()).alias("alive"))
    there = F.when(F.col("alive"), F.col("turn")).cast("decimal(38,0)")
    gaps = turns.groupBy("conv_id").agg(F.coalesce(F.max(there) - F.min(there) + 1 - F.count(there), F.lit(0)).cast("long").alias("gaps"))
    strings = symbols(stored(ordered(rows), "turns-order")).withColumnRenamed("conv_id", "same")
    heads = repaired(gaps.join(strings, F.col("conv_id").eqNullSafe(F.col("same")), "left").drop("same"))
    names = ["gaps", *[f.split()[0] for f in HEAD.split(", ")]]
    nothing = [F.lit(None).cast(t).alias(c) for c, t in rows.select("turn", "key", "role", "text", "n").dtypes]
    stream = heads.select("conv_id", F.lit(0).alias("kind"), *nothing, *names).unionByName(
        rows.select("conv_id", F.lit(1).alias("kind"), "turn", "key", "role", "text", "n",
                    *[F.lit(None).cast(t).alias(c) for c, t in heads.select(*names).dtypes]))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "key")

    from pyspark.sql.pandas.types import to_arrow_schema
    out = stream.select("conv_id", *names).withColumn("repaired_sha256", F.lit("")).schema
    arrow = to_arrow_schema(out)

    def run(batches):
        head = hasher = None
        for b in batches:
            ready = []
            kind, role, text, n = (b.column(c).to_pylist() for c in ("kind", "role", "text", "n"))
            for i, k in enumerate(kind):
                if k == 0:
                    if head is not None:
                        ready.append((*head, hasher.done()))
                    head = [b.column(c)[i].as_py() for c in ("conv_id", *names)]
                    hasher = Hasher(head[-1])
                else:
                    for _ in range(n[i]):
                        hasher.turn(role[i], text[i])
            if ready:
                yield batch(ready)
        if head is not None:
            yield batch([(*head, hasher.done())])

    def batch(rows_):
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows_), arrow)], schema=arrow)

    return stream.mapInArrow(run, out)


def op11(spark, sf_dir: str) -> DataFrame:
    return repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def _crc(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
            "lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295)")


_MOVES = ", ".join(f"({s}, {m}, {end}, '{'I' * m}', [{', '.join(repr(r + ':') for r in roles)}])" for s, m, end, roles in (
    (s, m, list(itertools.accumulate(range(m), lambda a, _: DUE[a], initial=s))[-1],
     [ROLE[a] for a in list(itertools.accumulate(range(m), lambda a, _: DUE[a], initial=s))[:m]]) for s in range(4) for m in range(4)))

OP11_SQL = f"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
    ORDER BY i) AS crc FROM range(256) r(i)),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations, tab),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE kind <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, role[1] AS r FROM d),
f AS (
  SELECT *, r || lag(r) OVER (PARTITION BY conv_id ORDER BY i DESC) AS pair,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 2
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 3
      WHEN regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS fault FROM o),
g AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
    count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
moves AS (SELECT * FROM (VALUES {_MOVES}) v(s0, m, s1, letters, roles)),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS turns FROM (SELECT DISTINCT conv_id FROM f)
  UNION ALL
  SELECT conv_id, i, state, cost, audit, turns FROM (
    SELECT dp.conv_id, f.i, e.state, dp.cost + 2 * moves.m + e.cost AS cost, dp.audit || moves.letters || e.letter AS audit,
      list_concat(list_concat(dp.turns, moves.roles), CASE e.letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
        ELSE [CASE WHEN moves.s1 = 2 THEN 'assistant:' ELSE 'user:' END || f.text] END) AS turns,
      row_number() OVER (PARTITION BY dp.conv_id, e.state ORDER BY dp.cost + 2 * moves.m + e.cost, dp.audit || moves.letters || e.letter) AS best
    FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1 JOIN moves ON moves.s0 = dp.state,
      LATERAL (SELECT unnest([
        {{'letter': 'D', 'cost': 3, 'state': moves.s1}},
        {{'letter': 'K', 'cost': CASE WHEN f.fault < 2 AND ((f.r = 's' AND moves.s1 = 0) OR (f.r = 'u' AND moves.s1 <> 2)
           OR (f.r = 'a' AND moves.s1 = 2)) THEN f.fault END,
          'state': CASE WHEN f.r = 's' THEN 1 WHEN moves.s1 = 2 THEN 3 ELSE 2 END}},
        {{'letter': 'R', 'cost': CASE WHEN f.fault < 2 THEN 2 + f.fault END, 'state': CASE WHEN moves.s1 = 2 THEN 3 ELSE 2 END}}]) AS e) l
    WHERE e.cost IS NOT NULL) WHERE best = 1),
last AS (
  SELECT dp.conv_id, dp.cost + 2 * moves.m AS cost, dp.audit || moves.letters AS audit, list_concat(dp.turns, moves.roles) AS turns,
    row_number() OVER (PARTITION BY dp.conv_id ORDER BY dp.cost + 2 * moves.m, dp.audit || moves.letters) AS best
  FROM dp JOIN g ON g.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = g.n JOIN moves ON moves.s0 = dp.state AND moves.s1 IN (0, 3))
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(array_to_string(turns, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN (SELECT * FROM last WHERE best = 1) l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""
