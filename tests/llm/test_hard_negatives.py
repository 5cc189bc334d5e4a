import numpy as np
import pytest

from cabmill.llm import hard_negatives as hn
from cabmill.llm import integer_scores

SCHEMA = "vec_id long, embedding array<double>, label int, positives string"


def brute(rows, positives=5, negatives=10, low=30, high=90, every=100):
    """rows: (vec_id, z as whole numbers, label), ids distinct."""
    out = set()
    clamp = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    score = lambda a, b: clamp(sum(int(x) * int(y) for x, y in zip(a, b)))
    for a, z, label in rows:
        if a % every:
            continue
        scored = sorted((-score(z, o), i, other) for i, o, other in rows if i != a and len(o) == len(z))
        own = [(i, -s) for s, i, other in scored if other == label][:positives]
        for p, ps in own:
            fits = [(i, -s) for s, i, other in scored if other != label and low * ps <= -100 * s <= high * ps]
            out |= {(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(fits[:negatives])}
    return out


def table(n=700, dim=12, seed=0, clusters=6):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, dim))
    v = centre[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * 0.4
    v[50:120] = v[20]  # copies, of several labels
    v[7] = 0
    return [(i, v[i].tolist(), int(rng.integers(0, 3)), "x") for i in range(n)]


def whole(rows):
    return [(i, np.floor(256 * np.array(v)), label) for i, v, label, _ in rows]


@pytest.mark.parametrize("row_bytes, anchor_bytes, least", [(16 << 20, 4 << 20, 1024), (8 * 12 * 40, 8 * 12 * 3, 1)])
def test_equals_brute_force(spark, monkeypatch, row_bytes, anchor_bytes, least):
    monkeypatch.setattr(hn, "ROW_BYTES", row_bytes)
    monkeypatch.setattr(hn, "ANCHOR_BYTES", anchor_bytes)
    monkeypatch.setattr(hn, "LEAST_ROWS", least)
    rows = table()
    odd = [(9000, None, 1, "x"), (9100, [1.0, None] + [0.0] * 10, 1, "x"), (9200, [float("nan")] * 12, 1, "x"),
           (9300, [float("inf")] * 12, 0, "x"), (None, rows[0][1], 1, "x"), rows[3], (9400, [], 2, "x"),
           (9500, rows[0][1], None, "x"), (9600, [1e308] * 12, 1, "x")]
    short = [(10_000 + i, [1.0 + i, 2.0], i % 2, "x") for i in range(0, 300, 50)]
    frame = spark.createDataFrame(rows + odd + short, SCHEMA)
    got = [tuple(r) for r in hn.hard_negatives(frame).collect()]
    want = brute(whole(rows)) | brute(whole(short))
    assert len(got) == len(want) and set(got) == want
    assert hn.hard_negatives(frame.limit(0)).count() == 0


def test_huge_components(spark):
    rng = np.random.default_rng(4)
    size = rng.choice([0.0, 5.0, 6.0, 8.0, 25.0, 31.0], 600)
    rows = [(i, (rng.normal(size=4) * 10.0 ** size[i]).tolist(), i // 7 % 2, "x") for i in range(600)]
    got = [tuple(r) for r in hn.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got and set(got) == brute(whole(rows)) and len(got) == len(set(got))


@pytest.mark.parametrize("dim", [2, 64])
def test_bounds_hold_and_leave_rows_out(dim):
    rng = np.random.default_rng(dim)
    centre = rng.normal(size=(20, dim)) * 3
    z = integer_scores.integers(centre[rng.integers(0, 20, 800)] + rng.normal(size=(800, dim)) * 0.05)
    z[5] = 0
    directions = hn.spread(hn._scaled(z, integer_scores.lengths(z)), 20)
    rows = hn.Stored(np.arange(800), rng.integers(0, 3, 800), z, hn.angles(z, directions))
    anchors = hn.Stored(np.arange(40), rows.labels[:40], z[:40], hn.angles(z[:40], directions))
    exact = (z @ z[:40].T).T
    scored = []
    plain = hn.Stored.scores
    for i in range(40):
        low, high = rows.bounds(anchors, i)
        assert (low <= exact[i]).all() and (exact[i] <= high).all()
    counted = lambda self, at, a, i: scored.append(len(at)) or plain(self, at, a, i)
    hn.Stored.scores = counted
    try:
        list(hn.positives_in(rows, anchors, 5))
    finally:
        hn.Stored.scores = plain
    assert sum(scored) < 0.5 * 40 * 800


def test_no_two_directions_are_alike():
    units = np.array([[1.0, 0], [-1.0, 0], [0, 1.0], [1.0, 0]])
    assert len(hn.spread(units, 4)) == 2 and len(hn.spread(units[:0], 3)) == 0
