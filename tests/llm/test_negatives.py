"""Hard negatives against scoring everything, and the trees by themselves."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("tableloom.llm")

from tableloom.llm import cover_tree  # noqa: E402
from tableloom.llm.cover_tree import CoverTree  # noqa: E402

DDL = "vec_id long, embedding array<double>, label int, uid string, `Lane` int, bucket map<string,int>"


def whole(v):
    return [int(np.floor(256 * x)) for x in v]


def plain_mine(rows):
    ok = [(i, whole(v), (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows
          if i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, q, label in ok:
        if a % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v)), i, other == label) for i, v, other in ok if i != a and len(v) == len(q)]
        for minus, p, _ in sorted(s for s in scored if s[2])[:5]:
            fit = sorted(s for s in scored if not s[2] and 50 * -minus <= 100 * -s[0] <= 95 * -minus)[:3]
            out += [(a, p, n + 1, i, -minus, -s) for n, (s, i, _) in enumerate(fit)]
    return sorted(out)


def mined(frame, rows):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    df = frame(DDL, [(*r, "u", 1, {"a": 1}) for r in rows])
    return sorted(tuple(r) for r in cover_tree.mine(df, "vec_id", "embedding", label, F.col("id") % 50 == 0).collect())


def cloud(seed, n, d, labels):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(labels, d))
    out = []
    for i in range(n):
        label = int(rng.integers(labels)) if i % 3 else 0  # a third of all rows has one label
        out.append((i, (middles[label] * rng.choice([0.5, 1.0]) + 0.6 * rng.normal(size=d)).round(3).tolist(), label))
    return out


@pytest.mark.parametrize("seed,block", [(1, 40), (2, 2048)])
def test_mining_equals_scoring_everything(frame, monkeypatch, seed, block):
    monkeypatch.setattr(cover_tree, "BLOCK_ROWS", block)
    monkeypatch.setattr(cover_tree, "CHUNK_ANCHORS", 3)
    rows = cloud(seed, 700, 8, 10)
    rows += [(1000 + i, [1.0, 0.5, 0.25, 0.0, -0.5, 0.0, 1.0, 0.125], i % 3) for i in range(120)]  # ties
    rows += [(1150, rows[3][1], 2), (1150, rows[3][1], 2), (1151, rows[3][1], 2), (1151, rows[3][1], 2)]  # repeated ids
    rows += [(1200, None, 1), (1250, [1.0] * 7 + [None], 1), (1300, [float("nan")] * 8, 1), (1350, [float("inf")] * 8, 1), (1400, [1.0] * 8, None), (None, [1.0] * 8, 1)]
    rows += [(2000 + 10 * i, [1.0, 2.0 - i / 9], i % 2) for i in range(12)] + [(3000, [], 1), (3001, [], 1), (3050, [0.0] * 8, 1)]  # other lengths
    got = mined(frame, rows)
    assert len(got) > 100 and got == plain_mine(rows)


def test_scores_beyond_doubles_and_longs_are_exact(frame):
    rng = np.random.default_rng(5)
    for size in (2.0**20, 2.0**22.2):
        rows = [(25 * i, (size * (1 + rng.random(4) / 2**18)).tolist(), i % 3) for i in range(30)]
        rows += [(10_001 + i, [0.7 * x for x in r[1]], (i + 1) % 3) for i, r in enumerate(rows)]
        assert mined(frame, rows) == plain_mine(rows)


def test_few_and_no_rows(frame):
    assert mined(frame, []) == []
    assert mined(frame, [(0, [1.0, 0.0], 1)]) == []
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 1), (2, [0.75, 0.5], 3), (3, [-1.0, 0.0], 1)]
    assert mined(frame, rows) == plain_mine(rows) == [(0, 1, 1, 2, 65536, 49152)]


def test_a_tree_covers_separates_and_bounds():
    rng = np.random.default_rng(9)
    points = np.floor(256 * np.vstack([rng.normal(size=(300, 5)), np.repeat(rng.normal(size=(3, 5)), 40, 0)])).astype(np.int64)
    longest = float((points.astype(float) ** 2).sum(1).max())
    tree = CoverTree.build(np.arange(len(points)), ["x"] * len(points), points, longest)
    x = np.column_stack([points, np.sqrt(longest - (points**2).sum(1))])
    kids = [tree.child[tree.first[i]:tree.first[i + 1]] for i in range(len(points))]
    assert sorted(i for k in kids for i in k) == list(range(1, len(points)))

    def below(i):
        return [i] + [j for k in kids[i] for j in below(k)]

    for i in range(len(points)):
        away = np.sqrt(((x[below(i)] - x[i]) ** 2).sum(1))
        assert away.max() <= tree.reach[i] + 1e-6
    query = points[7]
    scores = points @ query
    want = sorted(((int(s), i) for i, s in enumerate(scores) if 1000 <= s <= 60_000 and i != 7), key=lambda r: (-r[0], r[1]))[:4]
    assert tree.search(query, 7, "y", False, np.array([[1000, 60_000]]), 4, longest, np.float64) == [want]


def test_a_search_leaves_out_what_cannot_matter(monkeypatch):
    rng = np.random.default_rng(4)
    middles = 3000 * rng.normal(size=(30, 6))
    points = np.floor(np.repeat(middles, 60, 0) + 30 * rng.normal(size=(1800, 6))).astype(np.int64)
    longest = float((points.astype(float) ** 2).sum(1).max())
    tree = CoverTree.build(np.arange(1800), ["x"] * 1800, points, longest)
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, rows):
            seen.append(len(rows))
            return np.asarray(self)[rows]

    tree.points = points.astype(float).view(Watched)
    scores = points @ points[0]
    best = sorted(((int(s), i) for i, s in enumerate(scores) if i), key=lambda r: (-r[0], r[1]))[:3]
    assert tree.search(points[0], 0, "y", False, np.array([[0, best[0][0]]]), 3, longest, np.float64) == [best]
    assert sum(seen) < 900


def test_thresholds_round_to_the_window():
    for score in (1, 7, 99, 12345):
        low, high = (50 * score + 99) // 100, 95 * score // 100
        assert low >= Fraction(score, 2) > low - 1 and high <= Fraction(19 * score, 20) < high + 1
