import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cabmill.llm import lexical_tree as lt

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))


def brute(docs, items, k=10):
    vectors = [(i, Counter(terms(t))) for i, t, *_ in docs]
    vectors = [(i, c, sum(c.values())) for i, c in vectors if c]
    N, L = len(vectors), sum(n for *_, n in vectors)
    df = Counter(t for _, c, _ in vectors for t in c)
    wanted = defaultdict(set)
    for i, t, *_ in items:
        wanted[i].update(terms(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c, n in vectors:
            m = 100 - 90 + 90 * n * N // L
            s = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in own if c[t]
            )
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return out


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(150)] + ["ÑÑ", "É", "a1", "Ab"]
    weight = [1 / (1 + i) for i in range(len(words))]
    text = lambda: rng.choice([" ", "-", ".\n", "\x7f"]).join(rng.choices(words, weight, k=rng.randint(1, 60)))
    docs = [(i, text(), "x") for i in range(n)]
    docs += [(n + i, docs[3][1], "x") for i in range(40)]  # copies: ties
    docs += [(None, docs[3][1], "x"), (None, None, "x"), (5000, "", "x"), (5001, "...", "x"), (7, "w1 w1", "x"), (7, "w1 w1", "x")]
    docs.append((5002, "W1 w2 " * 3000, "x"))
    items = [(i, text(), "x") for i in range(25)]
    items += [(100, None, "x"), (101, "absent", "x"), (102, "", "x"), (3, "w140 é", "x"), (None, "w3 w9", "x"), (103, docs[3][1], "x")]
    return docs, items


@pytest.mark.parametrize("entries, block, part", [(1 << 20, 200_000, 1 << 20), (300, 40, 50)])
def test_equals_brute_force(spark, monkeypatch, entries, block, part):
    monkeypatch.setattr(lt, "TREE_ENTRIES", entries)
    monkeypatch.setattr(lt, "BLOCK_TERMS", block)
    monkeypatch.setattr(lt, "PART", part)
    docs, items = corpus(400, 1)
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items, "item_id long, text string, doc_id string")
    got = [tuple(r) for r in lt.lexical_search(d.repartition(3), b).collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(brute(docs, items), key=key)
    assert lt.lexical_search(d.limit(0), b).count() == 0
    assert lt.lexical_search(d, b.limit(0)).count() == 0


def test_search_leaves_documents_out():
    rng = np.random.default_rng(5)
    n, vocabulary = 4000, 300
    p = 1 / np.arange(1, vocabulary + 1)
    own = [np.unique(rng.choice(vocabulary, 25, p=p / p.sum())) for _ in range(n)]
    sizes = np.array([len(x) for x in own])
    tf, m = rng.integers(1, 6, sizes.sum()), rng.integers(30, 300, n)
    tree = lt.Tree(m, sizes, np.concatenate(own), tf)
    # Fewer nodes than elements: paths are shared; each node covers its documents.
    assert len(tree.depth) < sizes.sum() and (tree.first < tree.end).all()
    starts = np.cumsum(sizes) - sizes
    w = np.floor(1000 * np.log(n / (1 + np.bincount(np.concatenate(own), minlength=vocabulary)))).astype(np.int64)
    scored = 0
    for _ in range(20):
        query = np.unique(rng.choice(vocabulary, 12))
        query = query[w[query] > 0]
        view, best = tree.view(query, w[query]), lt.Best(10)
        ids = np.arange(n) * 7 % 4001
        scored += lt.search(view, best, ids, np.zeros(n, bool))
        want = []
        for d in range(n):
            s = slice(starts[d], starts[d] + sizes[d])
            hit = np.isin(own[d], query)
            score = int(lt.gains(w[own[d]][hit], tf[s][hit], m[d]).sum())
            if score:
                want.append((-score, int(ids[d])))
        assert list(zip((-best.score).tolist(), best.doc_id.tolist(), strict=True)) == sorted(want)[:10]
    assert scored < 0.5 * 20 * n
