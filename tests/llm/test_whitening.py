import math
import random
from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import whitening as W
from ledgerloom.session import scratch_path

SCHEMA = "vec_id bigint, embedding array<float>, component int, n bigint, whitened string"


def _frame(spark, rows):
    return spark.createDataFrame([(a, v, 3, 4, "x") for a, v in rows], SCHEMA)


def _whole(v):
    if v is None or not v or any(c is None or not math.isfinite(c) for c in v):
        return None
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)


def _check(rows, got, components=16):
    """Every column against exact sums and a reckoning of its own."""
    x = {k: _whole(v) for k, v in rows}
    fit = sorted({v for v in x.values() if v})
    n, d = len(fit), len(fit[0])
    sums = [sum(v[i] for v in fit) for i in range(d)]
    dev = lambda v: [n * a - s for a, s in zip(v, sums)]
    exact = np.array([[float(Fraction(sum(dev(v)[i] * dev(v)[j] for v in fit), n ** 3)) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(exact)
    values, axes = values[::-1], axes[:, ::-1]
    count = min(components, d, int((values > 1e-13 * values[0]).sum()))
    assert sorted({r.vec_id for r in got}) == sorted(k for k, v in x.items() if v)
    assert len(got) == count * sum(v is not None for v in x.values())
    by_component = {}
    for r in got:
        v = x[r.vec_id]
        assert r.n == n and r.deviation == sum(a * a for a in dev(v))
        k = r.component - 1
        assert r.explained == pytest.approx(values[k] / np.trace(exact), rel=1e-12)
        assert r.identity_error <= 1e-10
        by_component.setdefault(k, []).append((r.whitened, np.dot([a / n for a in dev(v)], axes[:, k]) / math.sqrt(values[k])))
    assert sorted(by_component) == list(range(count))
    for k, pairs in by_component.items():
        apart = min([abs(values[k] - values[j]) for j in range(d) if j != k], default=1.0) / values[0]
        if apart > 1e-9:
            got_, want = np.array(pairs).T
            sign = np.sign(got_ @ want)
            assert np.allclose(got_ * sign, want, rtol=0, atol=1e-13 / apart + 1e-12)


def test_against_exact_sums(spark):
    draw = random.Random(12)
    rows = [(k, [draw.gauss(0, 1 + i / 3) for i in range(20)]) for k in range(300)]
    rows += [(1000 + k, rows[k % 3][1]) for k in range(500)]
    rows += [(2000, None), (2001, [None] + [0.5] * 19), (2002, [math.nan] + [0.5] * 19), (2003, [math.inf] + [0.5] * 19)]
    got = W.whiten(_frame(spark, rows).repartition(5), scratch_path(spark, "w")).collect()
    assert got[0].asDict().keys() == {"vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"}
    _check(rows, got)


def test_fewer_components_than_asked(spark):
    draw = random.Random(3)
    flat = [draw.gauss(0, 2) for _ in range(40)]
    rows = [(k, [a, 2.0, a, draw.random()]) for k, a in enumerate(flat)]
    _check(rows, W.whiten(_frame(spark, rows), scratch_path(spark, "w")).collect())


def test_odd_tables(spark):
    assert W.whiten(_frame(spark, []), scratch_path(spark, "w")).collect() == []
    assert W.whiten(_frame(spark, [(1, None), (2, [])]), scratch_path(spark, "w")).collect() == []
    alike = W.whiten(_frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0]), (None, [0.5, 1.0])]), scratch_path(spark, "w")).collect()
    assert sorted((str(r.vec_id), r.component, r.whitened) for r in alike) == [
        ("1", None, None), ("2", None, None), ("None", None, None)]
    rows = [(k, [float(k % 5), float(k * k % 7)]) for k in range(30)] + [(None, [1.0, 1.0]), (7, [3.0, 3.0])]
    mixed = W.whiten(_frame(spark, rows + [(99, [1.0]), (98, [1.0, 2.0, 3.0])]), scratch_path(spark, "w")).collect()
    assert sorted(r.vec_id for r in mixed if r.component is None) == [98, 99]
    assert len(mixed) == 2 * len(rows) + 2


def test_deviation_beyond_a_long():
    centre = W.Centre(3, [3_000_000, 3_000_000 + 3 * (1 << 40)])
    x = np.array([[1_000_001, 1_000_000], [1_000_000, 1_000_000 + (1 << 40)], [1_000_000, 1 << 50]])
    assert centre.deviations(x) == [9 + (3 << 40) ** 2 if (3 << 40) ** 2 + 9 < 1 << 63 else None, 0, None]


def _orthogonal(draw, n):
    return np.linalg.qr(draw.normal(size=(n, n)))[0]


@pytest.mark.parametrize("values", [
    np.arange(1.0, 41.0), np.geomspace(1e-6, 1e3, 40), np.repeat([1.0, 2.0, 5.0, 9.0], 10),
    1.0 + 1e-9 * np.arange(40), np.r_[np.full(20, 3.0), 3.0 + 1e-7 * np.arange(20)], np.zeros(40), np.ones(40)])
def test_refined_to_double_precision(values):
    """Residual and orthogonality are those of doubles, whatever the spacing of the eigenvalues."""
    q = _orthogonal(np.random.default_rng(4), 40)
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    found, axes = W.eigenpairs(matrix)
    size = max(np.abs(values).max(), 1e-300)
    assert np.allclose(found, np.linalg.eigvalsh(matrix)[::-1], rtol=0, atol=1e-13 * size)
    assert np.abs(axes.T @ axes - np.eye(40)).max() < 1e-13
    assert np.abs(matrix @ axes - axes * found).max() < 1e-13 * size


def test_each_step_doubles_the_digits():
    q = _orthogonal(np.random.default_rng(5), 30)
    matrix = (q * np.arange(1.0, 31.0)) @ q.T
    vectors = np.linalg.eigh(matrix.astype(np.float32))[1].astype(np.float64)
    sizes = []
    for _ in range(3):
        vectors, _, size = W.refine(matrix, vectors)
        sizes.append(size)
    assert 1e-9 < sizes[0] < 1e-4 and sizes[1] < 100 * sizes[0] ** 2 + 1e-15 and sizes[2] < 1e-13
