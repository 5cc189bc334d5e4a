import numpy as np
import pytest

from cabmill.llm import cells, exact_topk, permutation_index


def table(spark, n=900, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).astype(np.float32)
    v[100:160] = v[50]  # a common vector
    rows = [(int(i), [float(x) for x in v[i]], "q") for i in range(n)]
    odd = [(5000, None, "x"), (5050, [1.0, None] + [0.0] * 10, "x"), (5100, [float("nan")] * 12, "x"),
           (5150, [float("inf")] * 12, "x"), (None, rows[0][1], "x"), rows[3], (5200, [], "x"), (5250, [1.0, 2.0], "x")]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, query_id string")
    return frame, v.astype(float)


def nearest(score, ids, own, k):
    order = [j for j in np.lexsort((ids, -score)) if ids[j] != own][:k]
    return [(int(ids[j]), score[j]) for j in order]


@pytest.mark.parametrize("rows, queries", [(2048, 512), (64, 5)])
def test_exact_topk(spark, monkeypatch, rows, queries):
    monkeypatch.setattr(cells, "ROWS", rows)
    monkeypatch.setattr(cells, "QUERIES", queries)
    frame, v = table(spark)
    z, ids = np.floor(256 * v), np.arange(len(v))
    want = {
        (q, r + 1, i, int(s))
        for q in range(0, len(v), 50)
        for r, (i, s) in enumerate(nearest(z @ z[q], ids, q, 5))
    }
    assert {tuple(r) for r in exact_topk.exact_topk(frame).collect()} == want
    assert exact_topk.exact_topk(frame.limit(0)).count() == 0


def test_bounds_hold():
    rng = np.random.default_rng(1)
    rows, q = rng.integers(-50, 50, (200, 6)).astype(float), rng.integers(-9, 9, (7, 6)).astype(float)
    lists = exact_topk.SortedLists(rows)
    for depth in (1, 20, 100, 200):
        low, high = lists.bounds(q, depth)
        score = q @ rows.T
        assert (low <= score).all() and (score <= high).all()
    assert (low == score).all() and (high == score).all()


def test_scores_come_from_the_lists():
    rng = np.random.default_rng(8)
    rows, ids = rng.integers(-200, 200, (300, 64)).astype(float), np.arange(300)
    rows[:40] *= 8
    own, lists = np.arange(0, 300, 50), exact_topk.SortedLists
    depths = []

    class Read(lists):
        def bounds(self, queries, depth, *live):
            depths.append((depth, *map(len, live)))
            return super().bounds(queries, depth, *live)

    exact_topk.SortedLists = Read
    try:
        got = exact_topk.top_by_bounds(ids, rows, own, rows[own], 5)
    finally:
        exact_topk.SortedLists = lists
    assert got == [(q, i, int(s)) for q in own for i, s in nearest(rows @ rows[q], ids, q, 5)]
    assert depths[-1][0] == 300 and depths[-1][1] < 300


def test_huge_components(spark):
    rng = np.random.default_rng(6)
    size = rng.choice([0.0, 5.0, 7.0, 25.0, 30.0], 300)
    v = rng.normal(size=(300, 4)) * 10.0 ** size[:, None]
    rows = [(i, v[i].tolist()) for i in range(300)] + [(1000, [1e308] * 4)]
    z = [[int(x) for x in np.floor(256 * r)] for r in v]
    clamp = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    want = set()
    for q in range(0, 300, 50):
        scored = sorted((-clamp(sum(map(int.__mul__, z[q], z[i]))), i) for i in range(300) if i != q)
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in exact_topk.exact_topk(frame).collect()} == want


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (7, [0.5, 0.5])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in exact_topk.exact_topk(frame).collect()] == [(0, 1, 7, 256 * 128 + 512 * 128)]
    got = permutation_index.permutation_search(frame).collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(0, 7)] and abs(got[0].score - 3 / 10**0.5) < 1e-12


def test_footrule():
    rng = np.random.default_rng(2)
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1)[:, None])(rng.normal(size=(n, 8)))
    pivots, rows, m = unit(20), unit(50), 6
    index = permutation_index.PermutationIndex(pivots, rows, m)
    place = np.full((50, 20), m)
    np.put_along_axis(place, index.permutation(rows), np.arange(m)[None], 1)
    for q in unit(5):
        p = index.permutation(q[None])[0]
        own = np.full(20, m)
        own[p] = np.arange(m)
        assert (np.abs(place - own).sum(1) == m * (m + 1) - 2 * index.nearness(p)).all()


def test_permutation_index_finds_the_nearest(spark):
    frame, v = table(spark, dim=12)
    got = permutation_index.permutation_search(frame).collect()
    u = v / np.linalg.norm(v, axis=1)[:, None]
    ids, hits, total = np.arange(len(v)), 0, 0
    for q in range(0, len(v), 50):
        want = {i for i, _ in nearest(u @ u[q], ids, q, 5)}
        rows = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert len(rows) == 5 and [r.rank for r in rows] == [1, 2, 3, 4, 5]
        for r in rows:
            assert abs(r.score - u[q] @ u[r.vec_id]) < 1e-9
        hits, total = hits + len(want & {r.vec_id for r in rows}), total + 5
    assert hits / total >= 0.9
    assert permutation_index.permutation_search(frame.limit(0)).count() == 0


@pytest.mark.parametrize("noise", [0.02, 0.3])
def test_near_copies_hide_no_neighbours(noise):
    """A third of the rows are near copies of one: queries inside and outside find theirs."""
    rng = np.random.default_rng(7)
    v = rng.normal(size=(2048, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    near = rng.permutation(2048) < 683
    v[near] = v[near][0] + rng.normal(size=(683, 64)) * noise / 8
    v /= np.linalg.norm(v, axis=1)[:, None]
    sample = v[rng.permutation(2048)]
    pivots = sample[permutation_index._apart(sample, permutation_index.PIVOTS)]
    ids = np.arange(2048)
    run = permutation_index._searcher(pivots, 5, permutation_index.NEAREST, permutation_index.SHARE)
    for some in (np.flatnonzero(near)[:60], np.flatnonzero(~near)[:60]):
        found = {(q, i) for q, i, _ in run(ids, v, some, v[some])}
        want = {(q, i) for q in some for i, _ in nearest(v @ v[q], ids, q, 5)}
        assert len(found & want) / len(want) >= 0.9
