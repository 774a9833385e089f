"""op1, op4, op9 against the tokenizer libraries."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brute import texts
from queryscope.llm import packing, piece_bpe, token_counts
from queryscope.llm.common import tokenizer_file

MODEL = tokenizer_file("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PIECES = piece_bpe.Pieces(MODEL)
AWKWARD = st.lists(st.sampled_from([" ", "  ", "    ", "the", "ing", "\n", "\t", "é", "中", "😀", "▁", "x", "0", ".", ",", "T", "tion", "\x00"]),
                   max_size=60).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.one_of(AWKWARD, st.text(max_size=40)))
def test_piece_bpe_is_the_library(s):
    enc, dec = piece_bpe.Encoder(PIECES), piece_bpe.Decoder(PIECES)
    ids = list(memoryview(enc.encode(s)).cast("i"))
    assert ids == LIBRARY.encode(s)
    assert dec.decode(ids) == LIBRARY.decode(ids)


@pytest.mark.parametrize("which", ["small", "awkward", "empty"])
def test_op4(spark, request, which):
    sf = request.getfixturevalue(which)
    docs = texts(spark, sf)
    rows = piece_bpe.op4(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        ids = LIBRARY.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def best_count(trie, s):
    """Plain forward pass over one string."""
    best, count = [0.0] + [float("-inf")] * len(s), [0] * (len(s) + 1)
    for d in range(1, len(s) + 1):
        if s[d - 1] not in trie.score:
            best[d], count[d] = best[d - 1] + trie.unknown, count[d - 1] + len(s[d - 1].encode())
        for j in range(d - 1, -1, -1):
            v = trie.score.get(s[j:d])
            if v is not None and best[j] + v >= best[d]:
                best[d], count[d] = best[j] + v, count[j] + 1
    return count[-1]


def test_trie_counts_are_the_plain_pass():
    trie, r = token_counts.TrieCounts(PIECES), random.Random(5)
    known = [c for c in "  etaoinshrTHE.,éü中x0123"] + ["the", "ing", "tion", "\n", "\t", "͸"]
    some = ["".join(r.choice(known) for _ in range(r.randint(0, 60))) for _ in range(1000)]
    assert trie.counts(some)[0] == [best_count(trie, piece_bpe.SPACE + s.replace(" ", piece_bpe.SPACE)) if s else 0 for s in some]


@pytest.mark.parametrize("which", ["small", "awkward", "empty"])
def test_op9(spark, request, which):
    sf = request.getfixturevalue(which)
    docs, trie = texts(spark, sf), token_counts.TrieCounts(PIECES)
    rows = token_counts.op9(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        t = docs[r.doc_id]
        if len(t) < 3000:
            assert r.n_tokens == (best_count(trie, piece_bpe.SPACE + t.replace(" ", piece_bpe.SPACE)) if t else 0)


def test_rank_file_gives_the_ids_of_the_json_file():
    json_ = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    enc = packing.encoder(tokenizer_file("byte_bpe_50k.tiktoken"))
    some = [f"a{chr(c)}1 {chr(c)} b{chr(c)}{chr(c)}!  {chr(c)}'s" for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    some += ["<|endoftext|>", "a <|endoftext|>b  <|endoftext|>", "\r\n \t\n  a\n\n b ", "it's IT'S I'LL 'tis", ""]
    assert [x.ids for x in json_.encode_batch(some, add_special_tokens=False)] == [enc.encode(s, allowed_special="all") for s in some]


def check_pieces(spark, sf, rows, size=1024):
    json_ = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = collections.Counter()
    ids = {}
    for r in table:
        x = np.array([*json_.encode(r.text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        ids[r.doc_id] = x
        want.update((r.doc_id, i) for i in range(len(x)))
    have, seqs = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        x = ids[r.doc_id]
        assert r.doc_tokens == len(x) and r.length > 0
        assert r.ids_crc32 == zlib.crc32(x[r.start:r.start + r.length].tobytes())
        have.update((r.doc_id, i) for i in range(r.start, r.start + r.length))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert have == want  # each id of each row lies in one piece
    padding = 0
    for v in seqs.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= size
        padding += 0 if at & (at - 1) == 0 else size - at
    return padding, sum(want.values())


@pytest.mark.parametrize("which", ["small", "awkward", "empty"])
def test_op1(spark, request, which):
    sf = request.getfixturevalue(which)
    padding, total = check_pieces(spark, sf, packing.op1(spark, sf).collect())
    assert padding <= 0.02 * total


def sequences_of(steps):
    """Ids in each sequence by the plan's ranges, as (first sequence, sequences, ids)."""
    return [(seq, n // per, per * size) for _, _, n, per, seq, _, _, size in steps]


@pytest.mark.parametrize("histogram", [
    {600: 10_000}, {513: 10_000}, {700: 5_000, 400: 100}, {600: 10_000, 1024: 5, 300: 200}, {1023: 7_777}, {1: 5_000}, {341: 9_999, 342: 3},
    {600: 10**12 + 7, 513: 10**11 + 3, 77: 5 * 10**11 + 1}, {l: 10**9 + l for l in range(520, 1000)}])
def test_chunks_of_few_lengths_leave_little_padding(histogram):
    """Padding of 2 % at most, ids all placed, and a plan that doesn't grow with the rests."""
    steps = packing.plan(histogram, 1024)
    total = sum(l * n for l, n in histogram.items())
    assert sum(n * size for _, _, n, _, _, _, _, size in steps) == total
    assert max(seq + n for seq, n, _ in sequences_of(steps)) <= 1.02 * total / 1024 + 11
    assert len(steps) <= 40 * len(histogram) + 100


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=40))
def test_plan_places_every_rest_once(histogram):
    fill, ranks = collections.Counter(), collections.defaultdict(list)
    for l, first, n, per, seq, at, start, size in packing.plan(histogram, 64):
        for k in range(n):
            fill[seq + k // per] += size
            ranks[l, first + k].append((start, size))
            assert at + (k % per) * size + size <= 64
    assert all(v <= 64 for v in fill.values())
    assert {l: sum(1 for a, _ in ranks if a == l) for l in histogram} == histogram
    for (l, _), parts in ranks.items():
        at = 0
        for start, size in sorted(parts):
            assert start == at
            at += size
        assert at == l
    total = sum(l * n for l, n in histogram.items())
    assert len(fill) <= 1.5 * total / 64 + 8  # far from one sequence a rest


def test_column_generation_meets_the_demand():
    r = np.random.default_rng(3)
    lengths = np.array(sorted(r.choice(np.arange(1, 200), 60, replace=False)))
    demand = r.integers(1, 5000, 60).astype(float)
    cols, x = packing.column_generation(lengths, demand, 200)
    assert np.allclose(cols @ x, demand, rtol=1e-6) and (lengths @ cols <= 200).all() and (x >= 0).all()
    duals = np.maximum(np.linalg.solve(cols.T, np.ones(60)), 0)
    best, _ = packing.knapsack(lengths, duals, 200)
    assert x.sum() <= 1.002 * (duals @ demand) / max(best[200], 1)  # the dual bound
