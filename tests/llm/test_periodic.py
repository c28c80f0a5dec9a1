import random

import numpy as np

from ledgerloom.llm import periodic as P
from tests.llm.helpers import AWKWARD, WORDS, docs_of


def _runs(w):
    """Every unbroken stretch of equal words q apart, for every q; of equal stretches the smallest q."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def _expected(docs):
    out = []
    for doc_id, text in docs:
        w = WORDS.findall(text or "")
        runs = _runs(w)
        gone = {k for start, length, q in runs for k in range(start + q, start + length)}
        out.append((doc_id, len(w), runs, " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def _got(frame):
    return sorted([(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) for r in frame.collect()], key=str)


def _texts(draw, n):
    for _ in range(n):
        letters = ["a", "b", "é", "漢c"][:draw.randint(1, 4)]
        text = [draw.choice(letters) for _ in range(draw.randint(0, 40))]
        for _ in range(draw.randint(0, 2)):
            period = [draw.choice(letters) for _ in range(draw.randint(1, 8))]
            text += (period * 8)[:draw.randint(3, 50)]
            text += [draw.choice(letters) for _ in range(draw.randint(0, 6))]
        yield "".join(w + draw.choice([" ", "\n", "\t ", "\x0b"]) for w in text)


def test_against_brute_force(spark):
    draw = random.Random(11)
    docs = AWKWARD + [(10 + k // 2, t) for k, t in enumerate(_texts(draw, 400))]
    docs += [(900, "a b " * 9), (901, "x " * 5), (902, "x " * 6), (903, "x y " * 3), (904, "x y " * 4), (905, "q " + "x y z " * 700)]
    assert _got(P.periodic_runs(docs_of(spark, docs).repartition(3))) == _expected(docs)


def test_runs_inside_runs(spark):
    """Runs that hold and overlap each other, as in words built from their predecessors."""
    a, b = "a", "ab"
    while len(b) < 600:
        a, b = b, b + a
    docs = [(1, " ".join(b)), (2, " ".join("aabaabaab" * 9 + "b" + "aab" * 30)), (3, "w " * 700 + "v " + "w " * 700)]
    assert _got(P.periodic_runs(docs_of(spark, docs))) == _expected(docs)


def test_blocks_of_positions(monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 4)
    draw = random.Random(5)
    for _ in range(60):
        w = [draw.choice("ab") for _ in range(120)] + list("abc" * 20) + ["a"] * 60
        counts = np.array([0, len(w), 0])
        assert P.find_runs(np.array([ord(x) for x in w], np.uint64), counts) == _runs(w)


def test_very_long_texts():
    for period in (1, 3):
        hashes = np.arange(200_000, dtype=np.uint64) % np.uint64(period)
        assert P.find_runs(hashes, np.array([200_000])) == [(0, 200_000, period)]


def test_suffix_edges():
    draw = random.Random(2)
    for _ in range(40):
        w = [draw.choice("ab") for _ in range(60)]
        cut = draw.randint(0, 60)
        owner = np.array([0] * cut + [1] * (60 - cut))
        parts = [(k, w[k:cut] if k < cut else w[k:]) for k in range(60)]

        def common(x, y):
            n = 0
            while n < min(len(x), len(y)) and x[n] == y[n]:
                n += 1
            return n

        want = []
        for part in (parts[:cut], parts[cut:]):
            part = sorted(part, key=lambda p: p[1])
            want += [(common(x, y), i, j) for (i, x), (j, y) in zip(part, part[1:]) if common(x, y) >= P.LEAST_LCP]
        a, b, lcp = P.suffix_edges(np.array([ord(x) for x in w]), owner)
        assert sorted(zip(lcp.tolist(), a.tolist(), b.tolist())) == sorted(want)
        assert (np.diff(lcp) <= 0).all()


def test_empty(spark):
    assert P.periodic_runs(docs_of(spark, [])).collect() == []
