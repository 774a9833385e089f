"""Turn repair, dedup against a perfect hash and phrase mining against plain forms."""

import collections
import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from queryscope.llm import perfect_hash, phrase_mining, turn_repair

SPACE = re.compile(r"[\x20\x09-\x0D]")


# ---------------------------------------------------------------- op11

def shortest(turns):
    """Cheapest, then least, edits by Dijkstra over (place, initials' state); turns: (fault, initial)."""
    go = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if i == len(turns) and last in ("", "a"):
            return cost, audit
        if (i, last) in done:
            continue
        done.add((i, last))
        for r in "ua":
            if (last, r) in go:
                heapq.heappush(heap, (cost + 2, audit + "I", i, r))
        if i < len(turns):
            fault, initial = turns[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
            if fault < 2:
                if (last, initial) in go:
                    heapq.heappush(heap, (cost + fault, audit + "K", i + 1, initial))
                for r in "ua":
                    if (last, r) in go:
                        heapq.heappush(heap, (cost + 2 + fault, audit + "R", i + 1, r))


TABLES = {b: turn_repair.Tables(b) for b in (1, 3, 4)}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("suao")), max_size=14), st.sampled_from([1, 3, 4]))
def test_edits_are_the_cheapest_and_least(turns, block):
    symbols = np.array([f * 4 + "suao".index(r) for f, r in turns], dtype=np.uint8)
    assert TABLES[block].repair(symbols) == shortest(turns)


def plain_repair(rows):
    """(conv_id, turn, role, text) -> conv_id -> the contract's columns."""
    convs = collections.defaultdict(list)
    for c, t, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        convs[c] += []
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        key = hashlib.sha256(f"{len('user' if kind == 4 else role)}:{'user' if kind == 4 else role}:{text}".encode()).digest()
        convs[c] += [(t is not None, t or 0, key, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for c, turns in convs.items():
        seen, faults, turns = set(), [], sorted(turns)
        for _, _, _, role, text in turns:
            ends = SPACE.sub("", text)[-1:]
            faults.append(2 if not ends else 3 if (role, text) in seen else int(ends not in ".!?"))
            seen.add((role, text))
        initials = [x[3][:1] for x in turns]
        ts = {t for known, t, *_ in turns if known}
        cost, audit = shortest([(f, r if r in ("s", "u", "a") else "o") for f, r in zip(faults, initials)])
        said, i, last = [], 0, ""
        for e in audit:
            due = "assistant" if last == "u" else "user"
            if e == "I":
                said.append(due + ":")
            elif e in "KR":
                said.append((turns[i][3] if e == "K" else due) + ":" + turns[i][4])
            last = said[-1][0] if e != "D" else last
            i += e != "I"
        out[c] = (max(ts) - min(ts) + 1 - len(ts) if ts else 0, faults.count(2), faults.count(3), faults.count(1),
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                  hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def as_dict(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


SCHEMA11 = "conv_id long, turn long, role string, text string, key string, n int, at map<string,int>"


def test_repair_equals_the_plain_form(spark, monkeypatch):
    r = random.Random(3)
    rows = []
    for c in [None, *range(60)]:
        n = 900 if c == 7 else r.randint(0, 9)
        for _ in range(n):
            t = r.choice([None, r.randint(0, 12), r.randint(0, 2000)])
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "USER"])
            text = r.choice([None, "", " \t\x0b", "a b.", "Hé?\n", "c! \x0c", "no end", ".", "😀", "x" * 5000, f"t{r.randint(0, 9)}."])
            rows += [(c, t, role, text)] * r.choice([1, 1, 1, 2, 5])
    df = spark.createDataFrame([(*x, "k", 1, {"a": 1}) for x in rows], SCHEMA11).repartition(5)
    monkeypatch.setattr(turn_repair, "PAGE_BITS", 3)
    assert as_dict(turn_repair.repair(df)) == plain_repair(rows)


def test_repair_of_nothing(spark):
    assert turn_repair.repair(spark.createDataFrame([], SCHEMA11)).count() == 0
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    only = spark.createDataFrame([(gone, 1, "user", "x", "k", 1, None)], SCHEMA11)
    assert as_dict(turn_repair.repair(only)) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


# ---------------------------------------------------------------- op12

@pytest.mark.parametrize("n", [0, 1, 2, 1000, 30000])
def test_perfect_hash_is_minimal(n):
    def digests(a, b):
        return perfect_hash.as_words(b"".join(hashlib.sha256(b"%d" % i).digest() for i in range(a, b)))

    words = digests(0, n)
    levels = perfect_hash.perfect_hash(words)
    assert sorted(perfect_hash.slots_of(words, levels).tolist()) == list(range(n))
    other = perfect_hash.slots_of(digests(n, n + 500), levels)
    assert ((other >= -1) & (other < max(n, 1))).all()


def plain_dedup(rows):
    groups = collections.defaultdict(list)
    for d, t in rows:
        t = t or ""
        groups[hashlib.sha256(SPACE.sub("", t).encode()).hexdigest()].append((-len(t), d is None, d or 0))
    out = []
    for h, members in groups.items():
        best = min(members)
        for i, (n, missing, d) in enumerate(sorted(members)):
            out.append((None if missing else d, None if best[1] else best[2], len(members), i == 0, h))
    return sorted(out, key=repr)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("middle", [-1, 40, 99, 1000])
def test_dedup_equals_the_plain_form(spark, monkeypatch, middle):
    r = random.Random(5)
    texts = [None, "", " \n", "a b c", "ab c ", "a\tbc", "é 😀", "x" * 9000, *(f"t {i}" for i in range(30))]
    rows = [(r.choice([None, r.randint(0, 100), 2**63 - 1, -2**63]), r.choice(texts)) for _ in range(300)]
    rows += [(5, "hot copy")] * 200 + [(6, "hot  copy")] * 3
    df = spark.createDataFrame([(*x, "k", {"a": 1}) for x in rows], "doc_id long, text string, row string, size map<string,int>").repartition(7)
    monkeypatch.setattr(perfect_hash, "SLOTS", 8)  # several shards and parts
    out = perfect_hash.deduplicate(df, F.col("doc_id") <= middle)
    assert shown(out) == plain_dedup(rows)
    known = {h for d, _, _, _, h in plain_dedup([x for x in rows if x[0] is not None and x[0] <= middle])}
    assert {r.text_sha256 for r in out.where("known").collect()} == known


def test_dedup_query_cases(spark, awkward, empty):
    rows = [tuple(x) for x in spark.read.parquet(f"{awkward}/documents.parquet").select("doc_id", "text").collect()]
    assert shown(perfect_hash.op12(spark, awkward)) == plain_dedup(rows)
    assert perfect_hash.op12(spark, empty).count() == 0


# ---------------------------------------------------------------- op13

def plain_collocations(rows, top=2000, least=30):
    """(lang, text)."""
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    many = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    cover = collections.Counter()
    for (lang, w), a in many.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                cover[lang, w[i:i + k]] = max(cover[lang, w[i:i + k]], a)
    out = collections.defaultdict(list)
    for (lang, w), a in many.items():
        if cover[lang, w] and 100 * cover[lang, w] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s)
                  for lang, found in out.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:top]))


def mined(df, top=2000):
    return sorted(tuple(r) for r in phrase_mining.collocations(df, top=top).collect())


def phrase_rows(seed, n=250):
    r = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "中文", "New", "york", "city", "hall", "a", "😀", "b-c"]
    rows = []
    for i in range(n):
        w = [r.choice(vocabulary) for _ in range(r.randint(0, 30))]
        if r.random() < 0.5:
            w += ["new", "york", "city", "hall"][:r.randint(2, 4)]
        rows.append((r.choice(["en", "en", "fr", None, "und"]), r.choice([" ", "  ", "\t"]).join(
            x + r.choice(["", "", "", ".", ",", "\n", "\x0b"]) for x in w)))
    # a word frequent only in the last documents, repeated rows, overlaps, nothing at all
    return rows + [("en", "late late late late bird")] * 40 + [(None, None), ("en", ""), ("fr", " \t"), ("xx", "one word")]


@pytest.mark.parametrize("cells", [1 << 25, 1 << 6])
@pytest.mark.parametrize("shards", [1, 3])
def test_phrases_equal_plain_counts(spark, monkeypatch, cells, shards):
    rows = phrase_rows(shards)
    monkeypatch.setattr(phrase_mining, "CELLS", cells)
    monkeypatch.setattr(phrase_mining, "BLOCK", min(cells, 1 << 10))
    monkeypatch.setattr(phrase_mining, "SHARDS", shards)
    df = spark.createDataFrame([(*x, 1, "p") for x in rows], "lang string, text string, n int, phrase string").repartition(3)
    assert mined(df) == plain_collocations(rows)
    assert mined(df, top=3) == plain_collocations(rows, top=3)


def test_every_cell_marked_at_once(spark, monkeypatch):
    """A table of marks in which all phrases share cells gives the same counts."""
    rows = phrase_rows(9)
    monkeypatch.setattr(phrase_mining, "mix", lambda x: phrase_mining_mix(x) & np.uint64(0xFFFFFFFFFC000000) | np.uint64(1))
    df = spark.createDataFrame(rows, "lang string, text string")
    assert mined(df) == plain_collocations(rows)


phrase_mining_mix = phrase_mining.mix


def test_phrase_query_cases(spark, awkward, empty):
    rows = [tuple(x) for x in spark.read.parquet(f"{awkward}/documents.parquet").select("lang", "text").collect()]
    assert sorted(tuple(r) for r in phrase_mining.op13(spark, awkward).collect()) == plain_collocations(rows)
    assert phrase_mining.op13(spark, empty).count() == 0
