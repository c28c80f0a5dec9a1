import math
import random

import numpy as np

from ledgerloom.llm import pivots
from ledgerloom.session import scratch_path
from tests.llm.helpers import components_of

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string"


def _frame(spark, rows):
    return spark.createDataFrame([(a, v, 1, "x") for a, v in rows], SCHEMA)


def _links(rows, threshold=0.9):
    fine = []
    for k, (a, v) in enumerate(rows):
        if a is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(np.float64)
        fine.append((k, a, x / np.linalg.norm(x)))
    return [(k, i, a, b) for n, (k, a, x) in enumerate(fine) for i, b, y in fine[:n]
            if len(x) == len(y) and x @ y >= threshold]


def _rows():
    draw = np.random.default_rng(4)
    rows = []
    for c in range(12):
        centre = draw.normal(size=16)
        for k in range(int(draw.integers(1, 40))):
            rows.append((100 * c + k + 20, (centre + draw.normal(size=16) * 0.2).tolist()))
    rows += [(1, None), (2, []), (3, [0.0] * 16), (4, [None] + [1.0] * 15), (5, [float("nan")] * 16), (6, [float("inf")] * 16),
             (7, [1e-30] + [0.0] * 15), (8, [3e30] + [0.0] * 15), (9, [-1.0] + [0.0] * 15), (10, rows[0][1]), (11, rows[0][1]),
             (12, [2 * x for x in rows[0][1]]), (13, [1.0, 0.0]), (14, [2.0, 0.0]), (None, rows[0][1]), (15, [1.0]), (15, [1.0])]
    return rows


def test_against_brute_force(spark, monkeypatch):
    rows = _rows()
    links = _links(rows)
    count = [0] * len(rows)
    for k, i, _, _ in links:
        count[k] += 1
        count[i] += 1
    component = components_of({a for a, _ in rows if a is not None}, [(a, b) for *_, a, b in links])
    want = sorted(((a, n, component.get(a), a is None or component[a] == a) for (a, _), n in zip(rows, count)), key=str)
    for block in (2048, 5):
        monkeypatch.setattr(pivots, "BLOCK", block)
        got = pivots.near_vectors(_frame(spark, rows), scratch_path(spark, "v")).collect()
        found = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str)
        recall = sum(r.n_links for r in got) / sum(count)
        assert recall >= 0.9 and len(got) == len(rows)
        assert all(r[1] <= w[1] for r, w in zip(found, want))
        if recall == 1:
            assert found == want


def test_recall_in_tight_groups(spark):
    """Many vectors around few centres, as copies of one text have them."""
    draw = np.random.default_rng(6)
    centres = draw.normal(size=(6, 32))
    rows = [(k, (centres[k % 6 if k < 400 else 0] + draw.normal(size=32) * 0.12).tolist()) for k in range(700)]
    rows += [(1000 + k, draw.normal(size=32).tolist()) for k in range(300)]
    got = pivots.near_vectors(_frame(spark, rows), scratch_path(spark, "v")).collect()
    assert sum(r.n_links for r in got) >= 0.99 * 2 * len(_links(rows))


def test_recall_near_the_threshold():
    """Pairs whose cosine is just 0.9 are the hardest to retrieve."""
    draw = np.random.default_rng(5)
    x = draw.normal(size=(4000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = draw.normal(size=(4000, 64))
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.93 * x + math.sqrt(1 - 0.93**2) * y
    points = pivots.spaced(x[draw.permutation(4000)], int(pivots.PIVOT_FACTOR * math.sqrt(8000)))
    a, b = pivots.nearest(x, points), pivots.nearest(y, points)
    found = [len(set(p[:pivots.LISTS]) & set(q[:pivots.LISTS])) > 0 and len(set(p) & set(q)) >= pivots.SHARED
             for p, q in zip(a.tolist(), b.tolist())]
    assert sum(found) / len(found) >= 0.9


def test_recall_at_the_threshold_with_most_pivots():
    """The more pivots, the less two vectors agree on the nearest ones: at cosine 0.9 exactly, 0.9 must still meet."""
    draw = np.random.default_rng(7)
    x = draw.normal(size=(pivots.MOST_PIVOTS + 3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    points, drawn, x = x[:pivots.MOST_PIVOTS], x[:-1000], x[-1000:]
    y = draw.normal(size=x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.9 * x + math.sqrt(1 - 0.9**2) * y
    lists = pivots.lists_for(drawn, points, 0.9)
    a, b = (pivots.nearest(v, points, pivots.prefix_for(lists)).tolist() for v in (x, y))
    found = [len(set(p[:lists]) & set(q[:lists])) > 0 and len(set(p) & set(q)) >= pivots.SHARED for p, q in zip(a, b)]
    assert sum(found) / len(found) >= 0.95
    assert pivots.lists_for(points, points, 0.9) == pivots.lists_for(x[:0], points, 0.9) == pivots.LISTS


def test_links_at_the_threshold_in_the_whole_operator(spark):
    """By three lists a vector, 9 of 100 of these pairs are lost."""
    draw = np.random.default_rng(8)
    x, y = draw.normal(size=(2, 1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.901 * x + math.sqrt(1 - 0.901**2) * y
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([x, y]))]
    got = pivots.near_vectors(_frame(spark, rows), scratch_path(spark, "v")).collect()
    assert sum(r.n_links for r in got) >= 0.97 * 3000


def test_empty(spark):
    assert pivots.near_vectors(_frame(spark, []), scratch_path(spark, "v")).collect() == []
    assert pivots.near_vectors(_frame(spark, [(1, None)]), scratch_path(spark, "v")).collect()[0].component_id == 1
