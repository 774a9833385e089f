"""op5, op7, op8, op10 against brute force."""

import collections
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from brute import PASSAGE, words
from queryscope.llm import byte_repeats, jaccard_join, line_templates, passages
from queryscope.llm.components import components

TABLES = ["small", "awkward", "empty"]


@pytest.mark.parametrize("which", TABLES)
def test_op8(spark, request, which):
    sf = request.getfixturevalue(which)
    want = brute.jaccard(brute.texts(spark, sf))
    rows = jaccard_join.op8(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


def test_near_copies_of_one_text_link_as_brute_force_says(spark):
    """One group of many near copies: stars first, the rest by prefixes."""
    r = random.Random(2)
    base = words(90, 3).split()
    docs = {}
    for i in range(60):
        w = list(base)
        for _ in range(r.randint(0, 7)):
            w[r.randrange(len(w))] = f"w{r.randrange(1000)}"
        docs[i * 7] = " ".join(w)
    docs.update({1000 + i: words(60, 400 + i) + " " + " ".join(base[:r.randint(20, 60)]) for i in range(20)})
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    rows = jaccard_join.jaccard_components(df).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in rows} == brute.jaccard(docs)


def test_prefixes_of_every_length_find_the_links(spark, monkeypatch):
    docs = {i: words(12, i // 2) + (" tail" if i % 2 else "") for i in range(12)}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    for cost in (0, 1000):  # makes l small, or large
        monkeypatch.setattr(jaccard_join, "VERIFY", cost)
        rows = jaccard_join.jaccard_components(df).collect()
        assert {x.doc_id: (x.n_shingles, x.component_id) for x in rows} == brute.jaccard(docs)


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + r.randrange(40), 200 + r.randrange(40)) for _ in range(25)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {x.node: x.component for x in rows} == {x: find(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("which", TABLES)
@pytest.mark.parametrize("hot", [256, 1])
def test_op7(spark, request, monkeypatch, which, hot):
    monkeypatch.setattr(byte_repeats, "HOT", hot)  # 1: every repeated anchor goes the way of frequent ones
    sf = request.getfixturevalue(which)
    want = brute.byte_repeats(brute.texts(spark, sf))
    rows = byte_repeats.op7(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == want


@pytest.mark.parametrize("length", [20, 24, 37, 150])
def test_short_strings_overlaps_and_rows_without_an_id(spark, length):
    r = random.Random(9)
    docs = {i: "".join(r.choice("ab") for _ in range(r.randint(0, 300))) for i in range(30)}
    docs[30] = "a" * 500
    df = spark.createDataFrame([*docs.items(), (None, "a" * 300)], "doc_id long, text string")
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans) for x in byte_repeats.without_repeats(df, length).select(
        "doc_id", "n_bytes", F.expr("aggregate(removed, 0L, (a, x) -> a + x.to - x.from)").alias("n_removed"), F.size("removed").alias("n_spans")).collect()}
    assert got.pop(None) == (300, 0, 0)
    assert got == {d: v[:3] for d, v in brute.byte_repeats(docs, length).items()}


@pytest.mark.parametrize("length", [1, 7, 8, 9, 20, 37, 100, 130])
def test_bucket_pointers_are_first_places_of_equal_strings(length):
    r = random.Random(length)
    pieces = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 260))) for _ in range(20)]
    pieces += [b"a" * 300, pieces[0], pieces[1][:150] + pieces[2], b"", bytes(range(256))]
    r.shuffle(pieces)
    size = np.array([len(x) for x in pieces], dtype=np.int64)
    base = np.cumsum(size) - size
    places = collections.defaultdict(list)
    for at, x in zip(base.tolist(), pieces):
        for i in range(len(x) - length + 1):
            places[x[i:i + length]].append(at + i)
    want = {(p, g[0]) for g in places.values() if len(g) > 1 for p in g}
    s, first = byte_repeats.refined(np.frombuffer(b"".join(pieces), dtype=np.uint8), base, size, length)
    assert len(s) == len(want) and set(zip(s.tolist(), first.tolist())) == want


def test_nothing_to_refine():
    none = np.zeros(0, dtype=np.int64)
    assert [len(x) for x in byte_repeats.refined(np.zeros(0, np.uint8), none, none, 100)] == [0, 0]


def test_compact_windows_are_the_wide_nodes_of_the_tree():
    r = random.Random(3)
    for _ in range(200):
        sizes = [r.randint(0, 40) for _ in range(5)]
        s = np.array([r.randint(0, 30) for _ in range(sum(sizes))], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        t = r.randint(2, 8)
        got = set(zip(*[x.tolist() for x in passages.compact_windows(s, first, t, passages.SEEDS[0])[:4]]))
        v, want = passages.mix(s ^ passages.SEEDS[0]), set()
        for d in range(5):
            w = v[first[d]:first[d + 1]].tolist()
            for c in range(len(w)):
                a = b = c
                while a > 0 and w[a - 1] > w[c]:
                    a -= 1
                while b < len(w) - 1 and w[b + 1] >= w[c]:
                    b += 1
                if b - a + 1 >= t:
                    want.add((d, c, a, b))
        assert got == want


def repeats(docs, n=50):
    """doc -> starts of n-word runs that an earlier document has."""
    seen, need = {}, collections.defaultdict(list)
    for d in sorted(docs):
        w, mine = brute.word_list(docs[d]), set()
        for i in range(len(w) - n + 1):
            run = tuple(w[i:i + n])
            if seen.get(run, d) != d:
                need[d].append(i)
            mine.add(run)
        for run in mine:
            seen.setdefault(run, d)
    return need


@pytest.mark.parametrize("which", TABLES)
def test_op5_finds_every_exact_repeat_and_reports_only_near_duplicates(spark, request, which):
    sf = request.getfixturevalue(which)
    docs = brute.texts(spark, sf)
    rows = passages.op5(spark, sf).collect()
    covered = collections.defaultdict(set)
    for r in rows:
        assert r.source_id < r.doc_id and r.end - r.start >= 50
        a = brute.word_list(docs[r.doc_id])[r.start:r.end]
        b = brute.word_list(docs[r.source_id])[r.source_start:r.source_end]
        x, y = brute.shingle_set(" ".join(a)), brute.shingle_set(" ".join(b))
        assert len(x & y) / len(x | y) == pytest.approx(r.similarity) and r.similarity >= 0.75
        assert brute.word_list(docs[r.doc_id].encode()[r.from_byte:r.to_byte].decode()) == a
        covered[r.doc_id].update(range(r.start, r.end))
    for d, starts in repeats(docs).items():
        assert all(k in covered[d] for i in starts for k in range(i, i + 50))
    if which == "awkward":
        assert {10, 14} <= set(covered) and 9 not in covered and 13 not in covered


def test_a_repeat_is_found_behind_a_common_text_that_is_too_short(spark):
    """Many documents have the 48 words in the middle; two of them share two more on either side."""
    docs = {}
    for k in range(12):
        common, left, right = words(48, 2000 + k), words(2, 2100 + k), words(2, 2200 + k)
        docs.update({100 * k + i: f"{words(60, 3000 + 100 * k + i)} {common} {words(60, 5000 + 100 * k + i)}" for i in range(10)})
        docs.update({100 * k + i: f"{words(60, 3000 + 100 * k + i)} {left} {common} {right} {words(60, 5000 + 100 * k + i)}" for i in (50, 90)})
    rows = passages.repeated_passages(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {(r.doc_id, r.source_id) for r in rows} == {(100 * k + 90, 100 * k + 50) for k in range(12)}
    assert all((r.start, r.end, r.similarity) == (60, 112, 1.0) for r in rows)


def test_windows_that_point_elsewhere_do_not_part_those_that_agree():
    """Hashes 0 and 2 agree on one place of the source, 1 points to another, 3 to none."""
    got = passages.stretches(np.array([[0, 10, 60, 510, 560], [1, 11, 62, 1011, 1062], [2, 13, 64, 513, 564]]))
    assert got == [(10, 64, 510, 564)]


def test_windows_that_overlap_in_both_documents_are_in_one_stretch():
    r = random.Random(5)
    for _ in range(300):
        ws = [(r.randrange(4), l := r.randrange(300), l + r.randint(5, 40), l0 := r.randrange(300), l0 + r.randint(5, 40)) for _ in range(r.randint(1, 40))]
        of = list(range(len(ws)))
        for i, a in enumerate(ws):
            for j, b in enumerate(ws):
                if a[1] <= b[2] and b[1] <= a[2] and a[3] <= b[4] and b[3] <= a[4]:
                    of = [of[i] if x == of[j] else x for x in of]
        got = passages.stretches(np.array(ws))
        for k in set(of):
            own = [w for w, x in zip(ws, of) if x == k]
            if len({w[0] for w in own}) >= passages.ENOUGH:
                l, r_, l0, r0 = min(w[1] for w in own), max(w[2] for w in own), min(w[3] for w in own), max(w[4] for w in own)
                assert any(x[0] <= l and r_ <= x[1] and x[2] <= l0 and r0 <= x[3] for x in got)


@pytest.mark.parametrize("later", [True, False])
@pytest.mark.parametrize("n, at, more, share", [(84, 42, 13, 76 / 97), (54, 47, 7, 46 / 61)])
def test_a_near_duplicate_with_a_block_inserted_is_one_passage(later, n, at, more, share):
    """84 words, and the same with 13 inserted in the middle; 54 words, and 7 inserted near the end."""
    a = words(n, 900).split()
    b = [*a[:at], *words(more, 901).split(), *a[at:]]
    x, y = (b, a) if later else (a, b)
    around = [words(40, 902 + i) for i in range(4)]
    s, first = passages.shingles(passages.Words([f"{around[0]} {' '.join(x)} {around[1]}", f"{around[2]} {' '.join(y)} {around[3]}"]), 5)
    sx, sa = s[:first[1]], s[first[1]:]
    got = passages.verified(sx, sa, (0, len(sx) - 1, 0, len(sa) - 1), 46)
    assert [v[:3] for v in got] == [(40, 40 + len(x) - 5, 40)]
    assert share <= got[0][4] and got[0][3] <= 40 + len(y) - 5  # the source may do without the few words past the block


def test_a_stray_match_does_not_lengthen_a_passage():
    a, own, stray = words(200, 910), words(40, 911), words(5, 912)
    s, first = passages.shingles(passages.Words([f"{a} {own} {stray}", f"{stray} {a}"]), 5)
    sx, sa = s[:first[1]], s[first[1]:]
    assert passages.verified(sx, sa, (0, len(sx) - 1, 0, len(sa) - 1), 46) == [(0, 195, 5, 200, 1.0)]


def test_a_passage_is_found_beside_a_stretch_of_scattered_matches():
    """A stretch with every tenth word replaced, which is no near duplicate, and then 100 words with 13 inserted."""
    scattered, a = words(200, 920).split(), words(100, 921).split()
    changed = [w if i % 10 else words(1, 930 + i) + "q" for i, w in enumerate(scattered)]
    s, first = passages.shingles(passages.Words([" ".join([*changed, *a[:50], *words(13, 922).split(), *a[50:]]), " ".join([*scattered, *a])]), 5)
    sx, sa = s[:first[1]], s[first[1]:]
    got = passages.verified(sx, sa, (0, len(sx) - 1, 0, len(sa) - 1), 46)
    covered = {i for l, r, *_ in got for i in range(l, r + 1)}
    assert covered >= set(range(200, 200 + 113 - 4)) and all(v[4] >= 0.75 for v in got)


def test_passages_are_cut_from_later_documents(spark):
    head = words(60, 70)
    df = spark.createDataFrame([(1, head + " " + PASSAGE, 1), (2, PASSAGE + " " + words(55, 71), 2), (3, None, 3), (None, PASSAGE, 4)],
                               "doc_id long, text string, extra int")
    out = {(r.doc_id, r.extra): r.text for r in passages.without_passages(df, passages.repeated_passages(df)).collect()}
    assert out == {(1, 1): head + " " + PASSAGE, (2, 2): " " + words(55, 71), (3, 3): None, (None, 4): PASSAGE}


@pytest.mark.parametrize("which", TABLES)
def test_op10(spark, request, which):
    sf = request.getfixturevalue(which)
    table = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = line_templates.op10(spark, sf).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows) == brute.line_templates(table)
    if which == "awkward":
        assert all(r.n_dropped == 1 for r in rows if r.doc_id and 20 <= r.doc_id < 32)


def test_template_generalises_a_variable_word(spark):
    names = [words(1, 600 + i) for i in range(12)]
    table = [(i, f"{words(30, 700 + i)}\nThis article was written by {n} for the weekly paper\n{words(30, 800 + i)}") for i, n in enumerate(names)]
    rows = line_templates.drop_lines(spark.createDataFrame(table, "doc_id long, text string")).collect()
    assert all(r["__dropped"] == 1 for r in rows)


def test_the_pipeline_keeps_lines_that_agree_only_in_having_digits(spark):
    """Rows of numbers differ from text to text; one of them and a line with a number recur."""
    table = [(i, "\n".join([words(30, 700 + i), f"{i} {i * 7} {i * 31}", f"H{i}O", "1 2 3", f"Page {i} of this weekly paper", words(30, 800 + i)]), "en", "a") for i in range(12)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.text.split("\n") for r in corpus_pipeline.clean_lines(spark, docs, "").collect()}
    assert got == {i: [x for x in t.split("\n") if x != "1 2 3" and not x.startswith("Page ")] for i, t, *_ in table}


def test_near_duplicates_behind_a_shorter_common_text_are_found(spark):
    """Passages of 66 words with one word changed, 36 words of which ten earlier documents have: recall against all pairs."""
    r, docs, want = random.Random(11), {}, []
    for g in range(60):
        passage = words(66, 5000 + g).split()
        at = (0, 15, 30)[g % 3]
        for i in range(10):
            docs[100 * g + i] = words(40, 10**6 + 100 * g + i) + " " + " ".join(passage[at:at + 36]) + " " + words(40, 2 * 10**6 + 100 * g + i)
        docs[100 * g + 50] = words(60, 3 * 10**6 + g) + " " + " ".join(passage) + " " + words(60, 4 * 10**6 + g)
        passage[r.choice([i for i in range(66) if not at <= i < at + 36])] = "changed"  # in its own part
        docs[100 * g + 60] = words(30, 5 * 10**6 + g) + " " + " ".join(passage) + " " + words(30, 6 * 10**6 + g)
        want.append((100 * g + 60, 100 * g + 50))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    found = {(x.doc_id, x.source_id): x for x in passages.repeated_passages(df).collect()}
    assert all(x.similarity >= 0.75 and x.end - x.start >= 50 for x in found.values())
    print("recall", np.mean([w in found for w in want]))
    assert np.mean([w in found for w in want]) >= 0.95
    assert set(found) <= set(want)


@pytest.mark.parametrize("copies", [1, 12])
def test_near_duplicates_behind_many_shorter_texts_that_overlap_are_found(spark, copies):
    """Earlier documents have 38 of 64 words each, from every fifth on: no one is a source, and each shingle's first ones are theirs."""
    docs, want = {}, []
    for g in range(8):
        passage = words(64, 7000 + g).split()
        for k in range(6):
            for i in range(copies):
                d = 1000 * g + 20 * k + i
                docs[d] = words(40, 10**6 + d) + " " + " ".join(passage[5 * k:5 * k + 38]) + " " + words(40, 2 * 10**6 + d)
        docs[1000 * g + 500] = words(60, 3 * 10**6 + g) + " " + " ".join(passage) + " " + words(60, 4 * 10**6 + g)
        passage[(12, 32, 51)[g % 3]] = "changed"
        docs[1000 * g + 600] = words(30, 5 * 10**6 + g) + " " + " ".join(passage) + " " + words(30, 6 * 10**6 + g)
        want.append((1000 * g + 600, 1000 * g + 500))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    rows = [x for x in passages.repeated_passages(df).collect() if (x.doc_id, x.source_id) in want]
    covered = collections.defaultdict(set)
    for x in rows:
        assert x.similarity >= 0.75
        covered[x.doc_id, x.source_id].update(range(x.start, x.end))
    assert all(len(covered[w] & set(range(30, 94))) >= 60 for w in want)


@pytest.mark.parametrize("vocabulary", [60, 400])
def test_open_windows_meet_all_that_share_enough_with_an_open_run(vocabulary):
    """Against all pairs: windows of three groups, made of pieces of some texts, with repeated shingles or hardly any."""
    r, t = random.Random(vocabulary), 46
    texts = [[r.randrange(vocabulary) for _ in range(120)] for _ in range(4)]
    n = 150
    size = np.array([r.randrange(t, 2 * t) for _ in range(n)])
    s = np.zeros((n, 2 * t - 1), dtype=np.uint32)
    for i in range(n):
        text, at = r.choice(texts), r.randrange(30)
        s[i, :size[i]] = [x if r.random() < 0.9 else r.randrange(10**6) for x in text[at:at + size[i]]]
    open_ = np.array([[r.random() < 0.2 and k < size[i] for k in range(2 * t - 1)] for i in range(n)])
    open_[::5] = False
    group, d = np.array([i % 3 for i in range(n)]), np.array([r.randrange(60) for _ in range(n)])
    source = np.array([i % 4 > 0 for i in range(n)])
    got = {(x, a): np.flatnonzero(c).tolist() for x, a, c, *_ in zip(*passages.sharing(group, d, size, s, open_, source, t))}
    need = collections.defaultdict(set)
    for x in range(n):
        for a in range(n):
            if group[a] == group[x] and d[a] < d[x] and source[a]:
                theirs, mine = set(s[a, :size[a]].tolist()), s[x, :size[x]].tolist()
                runs = [k for k in range(size[x] - t + 1) if any(y in theirs and o for y, o in zip(mine[k:k + t], open_[x, k:k + t]))
                        and len(set(mine[k:k + t]) & theirs) >= 0.75 * len(set(mine[k:k + t]))]
                ends = [k for k, y in enumerate(mine) if y in theirs or k in (0, size[x] - 1)]
                if any(len(set(mine[k:k + t])) < t for k in range(size[x] - t + 1)):
                    stretches = [(k, k + t) for k in runs]
                else:
                    told = [s[a, :size[a]].tolist().index(y) for y in mine if y in theirs]
                    told = told == sorted(told) and all(s[a, :size[a]].tolist().count(y) < 2 for y in mine)
                    stretches = []
                    for p, q in ((p, q) for p in ends for q in ends if q - p + 1 >= t):
                        at = [s[a, :size[a]].tolist().index(y) for y in mine[p:q + 1] if y in theirs]
                        if len(at) >= 0.75 * (q - p + 1 + (at[-1] - at[0] + 1 if told else len(at)) - len(at)):
                            stretches.append((p, q + 1))
                if runs:
                    need[x, a] = {k for p, q in stretches for k in range(p, q) if mine[k] in theirs and open_[x, k]}
    assert len(need) > 50 and got == {k: sorted(v) for k, v in need.items() if v}
    one = np.ones((2, 2 * t - 1), dtype=np.uint32)  # fewer shingles than places
    x, a, claim, *_ = passages.sharing(np.zeros(2, int), np.arange(2), np.array([50, 46]), one, one == 1, np.array([True, True]), t)
    assert (x.tolist(), a.tolist(), claim.sum()) == ([1], [0], 46)
    assert passages.bare(np.array([[2, 5], [4, 7], [7, 8], [9, 10]]), 11).nonzero()[0].tolist() == [0, 1, 8, 10]


def test_sources_are_tried_in_turns_until_their_places_are_in_a_passage(spark):
    ws = [(4, 0, 99, 0, 99)]
    pairs = spark.createDataFrame([(9, 0, a, 0, ws, places) for a, places in ((1, [60, 61]), (2, [3]), (3, [60, 70]), (4, [70]), (5, [61]), (6, [3, 5]))],
                                  "x long, xt long, a long, at long, ws array<struct<hash:int,l:int,r:int,l0:int,r0:int>>, claim array<int>")
    none = "doc_id long, text_hash long, start long, end long"
    turn = lambda found, most: {(r.a, r.now) for r in passages.next_to_try(pairs, spark.createDataFrame(found, none), most).collect()}
    assert turn([], 1) == {(1, True), (2, True), (3, True), (4, False), (5, False), (6, True)}
    assert turn([(9, 0, 55, 65), (9, 1, 0, 99), (8, 0, 0, 99)], 1) == {(1, True), (2, True), (3, True), (4, False), (5, False), (6, True)}
    assert turn([(9, 0, 55, 66)], 1) == {(2, True), (3, True), (4, False), (6, True)}  # places 55 to 61 are covered
    assert turn([(9, 0, 0, 75)], 4) == set()


def test_each_text_of_a_repeated_id_has_its_own_passages(spark):
    """Two texts of id 2: one repeats id 1 at its end, one repeats id 0 behind other words; the third has nothing."""
    other = words(60, 77)
    own = [words(n, 80 + n) for n in (55, 70, 90)]
    rows = [(0, other), (1, PASSAGE), (2, own[0] + " " + PASSAGE), (2, own[1] + " " + other + " " + own[2]), (2, own[2])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.cut_passages(spark, df, "")
    assert sorted((x.doc_id, x.text) for x in out.collect()) == sorted([(0, other), (1, PASSAGE), (2, own[0] + " "), (2, own[1] + "  " + own[2]), (2, own[2])])


def lines_left(spark, texts):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r["__lines"], r["__dropped"]) for r in line_templates.drop_lines(df).collect())
    assert got == [x[:3] for x in brute.line_templates(rows)]
    return got


def test_different_rows_of_numbers_stay(spark):
    got = lines_left(spark, ["\n".join([words(30, 700 + i), f"{i} {i * 7} {i * 31}", f"H{i}O", words(30, 800 + i)]) for i in range(12)])
    assert not any(n for *_, n in got)


def test_one_text_counts_once_however_many_lines_and_copies_it_has(spark):
    own = "\n".join(["This part was written by " + words(1, 40 + i) + " for the paper" for i in range(12)] + [words(90, 5)])
    got = lines_left(spark, [own] * 12 + [words(40, 60 + i) for i in range(5)])
    assert not any(n for *_, n in got)
    two = [own.replace("paper", "paper"), own + " end"]  # two texts with twelve such lines each
    assert not any(n for *_, n in lines_left(spark, two * 3))


def test_ten_texts_with_one_line_each_are_enough(spark):
    texts = [f"{words(40, 100 + i)}\nThis part was written by {words(1, 40 + i)} for the paper\n{words(40, 200 + i)}" for i in range(10)]
    assert all(n == 1 for *_, n in lines_left(spark, texts))
    assert not any(n for *_, n in lines_left(spark, texts[:9] * 3))


def test_pages_that_are_mostly_boilerplate_lose_it(spark):
    """Up to 6/7 of the characters are boilerplate; pages with more are near duplicates of each other and stay whole."""
    menu = "\n".join(words(6, 900 + k) for k in range(12))
    for share, gone in ((0.55, 12), (0.84, 12), (0.88, 0)):
        pages = []
        for i in range(12):
            own = round(len(menu.replace("\n", "")) * (1 - share) / share)
            pages.append(menu + "\n" + words(own, 1000 + i)[:own].strip())
        assert {n for *_, n in lines_left(spark, pages)} == {gone}


def test_one_of_each_group_stays_and_no_text_of_a_repeated_id_is_lost(spark):
    r, rows = random.Random(5), []
    texts = [words(60, 300 + k) for k in range(8)]
    for _ in range(120):
        d = r.choice([None, *range(12)])
        t = r.choice([None, "", " ", *texts, *[t + " end" for t in texts]])
        rows.append((d, t, r.choice([None, 1, 2]), {"a": 1}, [r.choice("xy")], "k", "c"))
    schema = "doc_id int, text string, n int, size map<string,int>, at array<string>, key string, component string"
    df = spark.createDataFrame(rows, schema).repartition(5)
    out = jaccard_join.one_of_each(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    got = out.select("doc_id", "text", "n", "at").collect()
    assert sum(x.doc_id is None for x in got) == sum(x[0] is None for x in rows)
    group = {t: k for k, t in enumerate(texts)} | {t + " end": k for k, t in enumerate(texts)}
    least, empty = {}, set()
    for d, t, *_ in rows:
        if d is not None and t in group:
            least[group[t]] = min(d, least.get(group[t], d))
        elif d is not None:
            empty.add(d)
    have = collections.Counter((x.doc_id, group.get(x.text)) for x in got if x.doc_id is not None)
    assert have == collections.Counter([(d, k) for k, d in least.items()] + [(d, None) for d in empty])
    for x in got:  # of equal rows the least
        if x.doc_id is not None:
            same = [(y[1] is None, y[2] is not None, y[2] or 0, y[4]) for y in rows if y[0] == x.doc_id and (y[1] or "") == (x.text or "")]
            assert (x.text is None, x.n is not None, x.n or 0, x.at) == min(same)
    nothing = jaccard_join.one_of_each(df.where("false"))
    assert nothing.count() == 0


@pytest.mark.parametrize("copies,size", [(200, 300), (600, 120)])
def test_groups_on_both_sides_of_the_threshold(spark, copies, size):
    """Near copies with so many edits that their likeness to each other lies around 0.75, against all pairs."""
    r = random.Random(copies)
    base = brute.words(size, 7).split()
    docs = {0: " ".join(base)}
    for i in range(1, copies):
        w = list(base)
        for _ in range(r.randint(size // 60, size // 22)):
            w[r.randrange(size)] = f"edit{r.randrange(10**6)}"
        docs[i] = " ".join(w)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(6)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in jaccard_join.jaccard_components(df).collect()}
    want = brute.jaccard(docs)
    assert got == want and len({c for _, c in want.values()}) > 3
