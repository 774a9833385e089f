"""op2, op3, op6 and the pipeline."""

import collections
import hashlib
import os
import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from queryscope.llm import language_id, pivot_topk, weighted_sampling
from queryscope.llm.registry import ORACLE, QUERIES
from test_tokenizers import check_pieces

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))


def top(vectors, k=5):
    ints = {i: [int(np.floor(256.0 * float(x))) for x in v] for i, v in vectors.items()}
    out = set()
    for q in (i for i in ints if i % 50 == 0):
        s = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(ints[q], v)))), i) for i, v in ints.items() if i != q)[:k]
        out |= {(q, r + 1, i, -p) for r, (p, i) in enumerate(s)}
    return out


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_queries_are_their_sql(spark, small, key):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small}/{t}.parquet')")
    rows, want = QUERIES[key](spark, small), c.sql(ORACLE[key])
    assert sorted(rows.columns) == sorted(want.columns)
    assert sorted(map(tuple, rows.select(*want.columns).collect())) == sorted(want.fetchall())


def test_topk_ties_equal_vectors_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "BLOCK", 16)
    monkeypatch.setattr(pivot_topk, "FIRST", 2)
    r = np.random.default_rng(1)
    good = {i: r.normal(size=6).tolist() for i in range(0, 160)}
    good.update({i: [1.0, 0.5, 0.0, 0.0, 0.0, 0.0] for i in range(200, 300)})  # a large group of equal vectors
    good[310], good[350] = [2.0, 1.0], [3e18, 1.0]                             # shorter; products beyond 53 bits
    rows = [*good.items(), (400, None), (450, [1.0, None]), (451, [float("nan")]), (500, [float("inf")]), (None, [1.0]), (100, good[100])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(x.query_id, x.rank, x.vec_id, x.score) for x in pivot_topk.top_k(df).collect()}
    assert got == top({i: v + [0.0] * (6 - len(v)) for i, v in good.items()})


def test_topk_of_an_empty_table(spark, empty):
    assert pivot_topk.op2(spark, empty).count() == 0


def test_elimination_spares_candidates():
    """On grouped vectors the stopping rule leaves most of a block unevaluated."""
    r = np.random.default_rng(0)
    x = np.floor(256 * np.repeat(r.normal(size=(20, 8)), 50, axis=0) + r.normal(size=(1000, 8)))
    m2 = float((x * x).sum(1).max())
    pivots, table = pivot_topk.pivot_table(x, m2)
    seen = []
    plain = pivot_topk.products
    pivot_topk.products = lambda a, q: seen.append(len(a)) or plain(a, q)
    try:
        best = pivot_topk.search(np.arange(1000), x, m2, pivots, table, -1, x[0], 5)
    finally:
        pivot_topk.products = plain
    s = x @ x[0]
    assert best == sorted(((int(v), i) for i, v in enumerate(s)), key=lambda t: (-t[0], t[1]))[:5]
    assert sum(seen) < 1000


def test_a_threshold_spares_candidates_and_hides_what_is_below(monkeypatch):
    r = np.random.default_rng(3)
    x = np.floor(256 * np.repeat(r.normal(size=(20, 8)), 50, axis=0) + r.normal(size=(1000, 8)))
    m2 = float((x * x).sum(1).max())
    pivots, table = pivot_topk.pivot_table(x, m2)
    seen = []
    plain = pivot_topk.products
    monkeypatch.setattr(pivot_topk, "products", lambda a, q: seen.append(len(a)) or plain(a, q))
    s = np.sort(x @ x[0])[::-1]
    for least in (float(s[2]), float(s[0]) + 1, -np.inf):
        best = pivot_topk.search(np.arange(1000), x, m2, pivots, table, -1, x[0], 5, least)
        assert [a for a, _ in best] == [v for v in s[:5] if v >= least]
    assert seen[0] <= 128


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e150])
def test_topk_of_groups_beyond_a_block(spark, monkeypatch, scale):
    """Many blocks a cell, cells without a query, a third of all vectors equal; sums exact in a double or not."""
    monkeypatch.setattr(pivot_topk, "BLOCK", 8)
    monkeypatch.setattr(pivot_topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(pivot_topk, "PIVOTS", 6)
    r = np.random.default_rng(5)
    centres = r.normal(size=(6, 5))
    vectors = {i: (scale * (centres[0] if i % 3 == 0 else centres[i % 5 + 1] + 0.01 * r.normal(size=5))).tolist() for i in range(400)}
    df = spark.createDataFrame([*vectors.items()], "vec_id long, embedding array<double>")
    got = {(x.query_id, x.rank, x.vec_id, x.score) for x in pivot_topk.top_k(df).collect()}
    assert got == top(vectors)


def test_blocks_without_a_chance_are_left_out(spark, monkeypatch):
    monkeypatch.setattr(pivot_topk, "BLOCK", 64)
    r = np.random.default_rng(6)
    centres = r.normal(size=(16, 8))
    centres /= np.linalg.norm(centres, axis=1)[:, None]
    vectors = {i: (centres[i % 16] + 0.002 * r.normal(size=8)).tolist() for i in range(3200)}
    seen = {}
    plain = pivot_topk.stored
    monkeypatch.setattr(pivot_topk, "stored", lambda df, name: seen.setdefault(name, plain(df, name)))
    left = []
    where = type(spark.range(1)).where
    monkeypatch.setattr(type(spark.range(1)), "where", lambda self, c: left.append(where(self, c)) or left[-1])
    df = spark.createDataFrame([*vectors.items()], "vec_id long, embedding array<double>")
    got = {(x.query_id, x.rank, x.vec_id, x.score) for x in pivot_topk.top_k(df).collect()}
    assert got == top(vectors)
    pairs = next(f for f in left if "least_of_all" in f.columns)
    every = seen["topk-queries"].count() * seen["topk-candidates"].count()
    assert pairs.count() <= every / 4


@pytest.mark.parametrize("which", ["small", "awkward", "empty"])
def test_op6(spark, request, which):
    sf = request.getfixturevalue(which)
    docs = brute.texts(spark, sf)
    ids = sorted(docs)
    rows = {r.doc_id: r for r in weighted_sampling.op6(spark, sf).collect()}
    assert set(rows) == set(docs)
    error, by_text = [], {}
    for i, d in enumerate(ids):
        t, after = docs[d], docs[ids[i - 1]]
        cut = len(t) // 3
        e = t[:len(t) - cut] + after[:cut]
        assert rows[d].n_chars == len(t) and rows[d].edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert by_text.setdefault(t, rows[d].fingerprint) == rows[d].fingerprint
        if t == e:
            assert rows[d].near_edited == 1.0 and rows[d].fingerprint == rows[d].edited_fingerprint
        error.append(rows[d].near_edited - brute.weighted_jaccard(t, e))
    if which == "small":
        assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.11
        assert np.mean([r.near_edited for r in rows.values()]) > 0.4 > 0.15 > np.mean([r.near_next for r in rows.values()])


def test_samples_estimate_the_generalised_jaccard(spark):
    weights = {0: {1: 3.0, 2: 1.0, 3: 0.5}, 1: {1: 1.0, 2: 4.0, 4: 0.25}, 2: {1: 3.0, 2: 1.0, 3: 0.5}}
    df = spark.createDataFrame([(d, w, x) for d, v in weights.items() for w, x in v.items()], "d int, w long, weight double")
    got = {r.d: r.samples for r in weighted_sampling.fingerprints(df, ["d"], samples=64).collect()}
    want = (1 + 1) / (3 + 4 + 0.5 + 0.25)
    assert got[0] == got[2]
    assert abs(np.mean([a == b for a, b in zip(got[0], got[1])]) - want) < 0.2


def test_two_weights_of_a_word_are_drawn_once_and_give_their_own_samples(spark):
    """Fingerprints of both texts in one pass are those of each text on its own, whatever words they share."""
    texts = [(0, "a b b c d", "a b c c e"), (1, "x y", "z z z"), (2, "", "a"), (3, "q r s", "q r s")]
    df = spark.createDataFrame(texts, "d int, own string, edited string")
    words = df.select("d", F.explode(weighted_sampling.bags(F.col("own"), F.col("edited"))).alias("x")).selectExpr(
        "d", "x.w", "cast(x.own as double) as tf", "cast(x.edited as double) as edited_tf")
    assert words.count() == 5 + 3 + 2 + 3
    got = {r.d: (r.a, r.b) for r in weighted_sampling.fingerprints(words, ["d"], weight={"tf": "a", "edited_tf": "b"}).collect()}
    for side, col in enumerate(("own", "edited")):
        alone = df.select("d", F.explode(weighted_sampling.bag(F.col(col))).alias("x")).selectExpr("d", "x.w", "cast(x.tf as double) as weight")
        assert {r.d: r.samples for r in weighted_sampling.fingerprints(alone, ["d"]).collect()} == {d: g[side] for d, g in got.items()}
    assert got[3][0] == got[3][1] and all(len(x) == weighted_sampling.SAMPLES for g in got.values() for x in g)


@pytest.mark.parametrize("which", ["small", "awkward", "empty"])
def test_op3(spark, request, which):
    sf = request.getfixturevalue(which)
    rows = language_id.op3(spark, sf).collect()
    n = spark.read.parquet(f"{sf}/documents.parquet").count() + spark.read.parquet(f"{sf}/pages.parquet").count()
    assert len(rows) == n and all((r.lang is not None) == r.accepted for r in rows)
    if which == "small":
        assert np.mean([r.lang == r.declared for r in rows]) > 0.98
    if which == "awkward":
        assert {r.doc_id for r in rows if not r.accepted and r.page_id is None} >= {3, 4}


def test_a_language_is_known_however_many_documents_the_others_have(spark):
    """Two of 2,502 labelled documents are in a language of other letters; a third such text has no label, and a label has one short text."""
    rare = lambda seed: brute.words(300, seed).translate(str.maketrans("abcdefghijklmnop", "абвгдежзиклмнопр"))
    rows = [(i, brute.words(20, i), "en", "a") for i in range(2500)]
    rows += [(3000, rare(1), "ru", "b"), (3001, rare(2), "ru", "b"), (3002, rare(3), None, "c"), (3003, "ξψω φχψ θλπ", "el", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    got = {r.doc_id: r.lang for r in language_id.keep_identified(docs).collect()}
    assert [got.get(3000 + i) for i in range(4)] == ["ru", "ru", "ru", "el"]
    assert all(got.get(i) == "en" for i in range(2500))


def test_language_of_unlabelled_text_is_held_out_accurate(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    langs, model = language_id.fit(docs.where("doc_id % 2 = 0"))
    rest = docs.where("doc_id % 2 = 1").selectExpr("doc_id", "text", "cast(null as string) as lang", "source", "n_chars")
    got = {r.doc_id: r.lang for r in language_id.fused(language_id.scored(language_id.document_rows(rest), model), langs).collect()}
    want = {r.doc_id: r.lang for r in docs.where("doc_id % 2 = 1").collect()}
    assert np.mean([got[d] == want[d] for d in want]) > 0.97


def test_host_prior_decides_where_the_text_cannot(spark):
    """One text of trigrams that no language has, on two hosts of one language each and on a host of its own."""
    rows = [(i, "le la les des une pour dans " * 20, "fr", "h1") for i in range(30)] + [(100 + i, "of the and to in that is up " * 20, "en", "h2") for i in range(30)]
    odd = [(200, "qzxj", None, "h1"), (201, "qzxj", None, "h2"), (202, "qzxj", None, "h3")]
    docs = spark.createDataFrame([*rows, *odd], "doc_id long, text string, lang string, source string")
    langs, model = language_id.fit(docs)
    out = {r.doc_id: r for r in language_id.fused(language_id.scored(language_id.document_rows(docs), model), langs).collect()}
    assert len(out) == 63 and out[200].lang == "fr" and out[201].lang == "en"
    assert out[200].posterior > 0.8 and out[201].posterior > 0.8 > out[202].posterior


def plain_fusion(rows, langs):
    """(key, declared, suffix, domain, host, score) -> key -> posterior vector: text x declared x suffix x host prior, row by row."""
    width = len(langs) + 1
    p = {r[0]: np.exp(np.array(r[5]) - max(r[5])) for r in rows}
    p = {k: v / v.sum() for k, v in p.items()}

    def counted(i, value, without=None):
        return sum((p[r[0]] for r in rows if r[i] == value and r[0] != without), np.zeros(width))

    out = {}
    for key, *evidence, score in rows:
        log = np.array(score)
        for i in (1, 2):  # declared language, address suffix
            value = evidence[i - 1]
            if value is not None:
                values = {r[i] for r in rows} - {None}
                total = sum((counted(i, v) for v in values), np.zeros(width))
                log = log + np.log((counted(i, value) + 0.5) / (total + 0.5 * len(values)))
        prior = np.full(width, 1 / width)
        for n in (sum(p.values()) - p[key], *(counted(i, evidence[i - 1], key) for i in (3, 4) if evidence[i - 1] is not None)):
            prior = (n + language_id.WEIGHT * prior) / (n.sum() + language_id.WEIGHT)
        log = log + np.log(prior)
        e = np.exp(log - log.max())
        out[key] = e / e.sum()
    return out


@pytest.mark.parametrize("held", [1, 4096])
def test_fusion_equals_the_plain_form(spark, monkeypatch, held):
    import random
    monkeypatch.setattr(language_id, "HELD", held)
    r = random.Random(held)
    langs = ["de", "en", "fr"]
    rows = []
    for i in range(120):
        host = r.choice([None, "a.x.fr", "b.x.fr", "c.y.de", "hot.z.com"])
        rows.append((i, r.choice([None, "de", "en", "fr", "xx"]), host and host.split(".")[-1], host and ".".join(host.split(".")[1:]), host,
                     [r.uniform(-3, 0) for _ in range(4)]))
    rows += [(200 + i, "en", "com", "z.com", "hot.z.com", [0.0, 2.0, 0.0, 0.0]) for i in range(60)]
    table = [(k, k, None, d, s, o, h, 5, sc, language_id.softmax(np.array([sc]))[0].tolist()) for k, d, s, o, h, sc in rows]
    df = spark.createDataFrame(table, "key long, doc_id long, page_id long, declared string, suffix string, domain string, host string, n long, "
                                      "score array<double>, p array<double>").repartition(5)
    want = plain_fusion(rows, langs)
    for x in language_id.fused(df, langs).collect():
        best = want[x.key]
        assert abs(x.posterior - best.max()) < 1e-9
        label = [*langs, None][int(best.argmax())]
        assert x.lang == (label if label is not None or x.declared in langs else x.declared)


def test_a_thousand_labels(spark):
    """As many classes as the bound allows, each with letters of its own."""
    rows = [(i, "".join(chr(0x4E00 + 20 * i + j) for j in range(20)) * 18, f"l{i:04}", "s") for i in range(1000)]
    rows += [(5000 + i, rows[i][1][:120], None, "t") for i in range(0, 1000, 100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    langs, model = language_id.fit(docs)
    assert len(langs) == 1000
    got = {r.doc_id: r.lang for r in language_id.fused(language_id.scored(language_id.document_rows(docs), model), langs).collect()}
    right = np.mean([got[i] == f"l{i:04}" for i in range(1000)])
    assert right > 0.99 and all(got[5000 + i] == f"l{i:04}" for i in range(0, 1000, 100))


def test_scores_of_huge_components_are_defined(spark):
    rows = [(0, [1e307, 1.0]), (1, [-1e308, 0.0]), (2, [1.0, 1.0]), (3, [1e300, 1e300]), (50, [1e308, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in pivot_topk.top_k(df, k=2).collect()}
    top, least = 2**63 - 1, -2**63
    assert got[0, 1] == (2, top) and got[0, 2] == (3, top) and got[50, 1] == (0, top) and got[50, 2] == (2, top)
    every = {(r.query_id, r.vec_id): r.score for r in pivot_topk.top_k(df, k=5).collect()}
    assert every[0, 1] == every[50, 1] == least


def test_noise_is_rejected(spark, small):
    import random
    r = random.Random(1)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    noise = [(10 ** 6 + i, "".join(chr(r.randrange(33, 127)) for _ in range(600)), None, "src1", 600) for i in range(5)]
    kept = language_id.keep_identified(docs.union(spark.createDataFrame(noise, docs.schema)))
    ids = {x.doc_id for x in kept.select("doc_id").collect()}
    assert not ids & {d for d, *_ in noise}
    assert len(ids) >= 0.99 * docs.count()


@pytest.mark.parametrize("which", ["small", "awkward", "empty"])
def test_pipeline_stages(spark, request, tmp_path, which):
    """Each stage against its plain form, on what the one before kept."""
    sf = request.getfixturevalue(which)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            kept[name] = [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]
    assert {d for d, _ in kept["language_id"]} >= {d for d, t in brute.texts(spark, sf).items() if len(t) > 200 and which == "small"}
    want = {(d, n) for d, _, _, n in brute.line_templates(kept["language_id"])}
    assert {(d, hashlib.sha256(t.encode()).hexdigest()) for d, t in kept["line_dedup"]} == want
    groups = brute.jaccard(dict(kept["line_dedup"]))
    assert sorted(d for d, _ in kept["near_duplicates"]) == sorted({c for _, c in groups.values()})
    before, after = dict(kept["near_duplicates"]), dict(kept["substring_dedup"])
    assert set(before) == set(after) and all(len(after[d]) <= len(before[d]) for d in before)
    import test_duplicates
    repeated = test_duplicates.repeats(before)
    left = test_duplicates.repeats(after)
    assert all(after[d] != before[d] for d in repeated) and not set(left) & set(repeated)
    folder = tmp_path / "packed"
    os.makedirs(folder)
    docs_path = tmp_path / "substring_dedup"
    os.symlink(docs_path, folder / "documents.parquet")
    padding, total = check_pieces(spark, str(folder), docs.collect())
    assert padding <= 0.02 * max(total, 1)


def test_run_is_the_stages(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    per = collections.Counter(r.doc_id for r in rows)
    assert rows and all(n > 0 for n in per.values())


def test_shuffle_files_go_when_a_table_is_written(spark):
    from queryscope.llm.common import stored
    manager = spark._jsc.sc().env().blockManager().diskBlockManager()
    before = {b for b in manager.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle")}
    kept = stored(spark.range(1000).selectExpr("id % 100 AS k").groupBy("k").count(), "shuffled")
    after = {b for b in manager.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle")}
    assert kept.count() == 100 and not after - before
