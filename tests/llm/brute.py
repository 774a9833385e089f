"""Plain forms of the operators, for small inputs."""

import collections
import hashlib
import random
import re


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n))


PASSAGE = words(70, 1000)
LINE = "Subscribe to our newsletter for weekly news and offers"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def texts(spark, sf):
    """doc_id -> text; repeated rows count once."""
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").distinct().collect()
    return {r.doc_id: r.text or "" for r in rows}


def word_list(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t.translate(UPPER))


def shingle_set(t):
    w = word_list(t)
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def jaccard(docs):
    sets = {d: shingle_set(t) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            o = len(sets[a] & sets[b])
            if sets[a] and 100 * o >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


def byte_repeats(docs, length=100):
    seen, out = set(), {}
    for d in sorted(docs):
        t = docs[d].encode()
        mark, end = bytearray(len(t)), 0
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            if s in seen:
                for k in range(max(i, end), i + length):
                    mark[k] = 1
                end = i + length
            else:
                seen.add(s)
        runs = sum(1 for i in range(len(t)) if mark[i] and (i == 0 or not mark[i - 1]))
        kept = bytes(b for b, m in zip(t, mark) if not m)
        out[d] = (len(t), sum(mark), runs, hashlib.sha256(kept).hexdigest())
    return out


def line_templates(rows, min_docs=10, depth=3, constant=0.7, most=(6, 7)):
    """rows: (doc_id, text).  Written from the rule: every count is of different texts."""
    def parse(line):
        """(tokens, number of tokens and leading ones, which tokens may be constant, the line's own name)"""
        raw = line.split()
        m = ["<*>" if re.search(r"\d", x) else x for x in raw]
        few = sum(x != "<*>" for x in m) < constant * len(m)
        return tuple(m), (len(m), tuple(m[:depth])), (("raw", *raw) if few else tuple(m))

    have, token_texts, template_texts = {}, collections.defaultdict(set), collections.defaultdict(set)
    for t in {t for _, t in rows}:
        for line in t.split("\n"):
            if line.split():
                m, leaf, name = parse(line)
                have[name] = (m, leaf)
                template_texts["own", name].add(t)
                for i, x in enumerate(m):
                    token_texts[leaf, i, x].add(t)
    template = {}
    for name, (m, leaf) in have.items():
        k = tuple(x if x != "<*>" and len(token_texts[leaf, i, x]) >= min_docs else None for i, x in enumerate(m))
        template[name] = (leaf, k) if sum(x is not None for x in k) / len(k) >= constant else ("own", name)
    for name, t in template.items():
        if t[0] != "own":
            template_texts[t] |= template_texts["own", name]
    out = []
    for d, t in rows:
        all_ = t.split("\n") if t else []
        kept = [x for x in all_ if not x.split() or len(template_texts[template[parse(x)[2]]]) < min_docs]
        if most[1] * (sum(map(len, all_)) - sum(map(len, kept))) > most[0] * sum(map(len, all_)):
            kept = all_
        out.append((d, len(all_), len(all_) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def weighted_jaccard(a, b):
    a, b = collections.Counter(re.split(r"[ \t-\r]+", a.strip())), collections.Counter(re.split(r"[ \t-\r]+", b.strip()))
    k = set(a) | set(b)
    return sum(min(a[x], b[x]) for x in k) / max(1, sum(max(a[x], b[x]) for x in k))
