import random
import re
from collections import Counter

import pytest

from cabmill.llm import jaccard_join as J


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and 180 * both >= 80 * (len(a) + len(sets[j])):
                root[find(i)] = find(j)
    first = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            r = find(i)
            first[r] = min(first.get(r, doc_id), doc_id)
    return Counter(
        (d, len(sets[i]), first.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)
    )


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    text = lambda n: [word() for _ in range(n)]
    rows, passage = [], text(30)
    bases = [text(rng.randint(5, 120)) for _ in range(12)]
    for b in bases:
        for _ in range(rng.randint(1, 12)):
            copy = list(b)
            for _ in range(rng.randint(0, max(1, len(b) // 30))):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [" ".join(text(rng.randint(20, 60)) + passage + text(rng.randint(0, 20))) for _ in range(40)]
    rows += [rows[0]] * 30 + ["", None, " \n\t", "One two", "one  TWO", "one", "x " * 4000, "x " * 3000]
    rows += ["É é", "é É", "ÀB cd ef gh ij", "ÀB CD ef gh ij"]
    rng.shuffle(rows)
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("frequent, long, block", [(500_000, 64, 512), (4, 2, 3)])
def test_matches_brute_force(spark, monkeypatch, frequent, long, block):
    monkeypatch.setattr(J, "FREQUENT", frequent)
    monkeypatch.setattr(J, "_LONG", long)
    monkeypatch.setattr(J, "_BLOCK", block)
    monkeypatch.setattr(J, "_SLICE", 7 if long == 2 else 4096)
    rows = corpus()
    rows += [rows[5], (None, rows[9][1]), (None, "quite another text than all others here")]
    docs = spark.createDataFrame(
        [(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, node string"
    )
    got = Counter(tuple(r) for r in J.jaccard_components(docs).collect())
    assert got == brute_force(rows)


def test_large_group_of_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        copy = list(base)
        for _ in range(rng.randint(0, 12)):
            copy[rng.randrange(150)] = f"u{rng.random()}"
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in J.jaccard_components(docs).collect()) == brute_force(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = J.jaccard_components(docs)
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0
