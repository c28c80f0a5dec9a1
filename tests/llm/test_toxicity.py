import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import toxicity as T
from ledgerloom.session import scratch_path
from tests.llm.helpers import AWKWARD, docs_of

INSULTS = ["blockhead", "nitwit", "scoundrel", "dimwit"]


def _text(draw, insults=()):
    parts = ["ka", "lo", "mi", "ter", "on", "sa", "ve", "ni", "do"]
    words = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(draw.randint(5, 60))]
    for word in insults:
        words.insert(draw.randrange(len(words) + 1), word)
    return " ".join(words) + "."


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(6)
    rows = [(k, _text(draw, [draw.choice(INSULTS)] if k % 4 == 0 else ()), int(k % 4 == 0)) for k in range(1200)]
    rows += [(5000, None, 1), (5001, "x", None), (None, "y", 0)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    return T.train(labelled.drop("toxic"), labelled.drop("text"), scratch_path(spark, "t"))


def _predicted(model, texts):
    return model.probability(T.evidence_of(model, pa.array(texts, pa.string()))) >= T.THRESHOLD


def test_unseen_texts(model):
    draw = random.Random(7)
    clean = [_text(draw) for _ in range(400)]
    toxic = [_text(draw, [draw.choice(INSULTS)]) for _ in range(200)]
    assert _predicted(model, clean).mean() < 0.02
    assert _predicted(model, toxic).mean() > 0.97


def test_gaps_and_insertions(model):
    changed = ["NITWIT!!", "nit-wit", "n.i.t.w.i.t", "blockxhead", "d i m w i t", "scound.rel", "(dimwit),", "b1ockhead"]
    found = _predicted(model, [f"ka lo miter {word} onsa ve" for word in changed])
    assert found.sum() >= 6, dict(zip(changed, found.tolist()))


def test_spaced_letters_are_told_by_letters_not_bytes():
    texts = pa.array(["le cr é t i n é ici", "ein D U M M S C H W Ä T Z E R da", "a e\u0301 t e\u0301", "é", None, "日 本 語"])
    distinct, codes, owner = T._tokens(texts)
    joined = [(distinct[c], o) for c, o in zip(codes.tolist(), owner.tolist()) if len(distinct[c]) >= 3]
    assert joined == [("ici", 0), ("ein", 1), ("étiné", 0), ("DUMMSCHWÄTZER", 1), ("ae\u0301te\u0301", 2), ("日本語", 5)]


def test_a_spaced_insult_with_an_accent(spark):
    draw = random.Random(9)
    rows = [(k, _text(draw, ["crétin"] if k % 4 == 0 else ()), int(k % 4 == 0)) for k in range(1200)]
    labelled = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = T.train(labelled.drop("toxic"), labelled.drop("text"), scratch_path(spark, "t"))
    assert _predicted(model, ["ka lo crétin onsa ve", "ka lo c r é t i n onsa ve", "ka lo miter onsa ve"]).tolist() == [
        True, True, False]


def test_margins_are_those_of_the_machine_that_was_fitted(model):
    """No word is left out, however little it is like a toxic landmark."""
    draw = random.Random(10)
    words = INSULTS + _text(draw).split()
    for word in INSULTS * 30:
        for _ in range(draw.randint(1, 2)):
            k = draw.randrange(1, len(word))
            word = word[:k] + draw.choice("qxz") + word[k:]
        words.append(word)
    pieces = sorted({piece for word in words for piece in T.pieces_of(word)})
    want = T._kernel(pieces, model.codes, model.units) @ model.weights + model.bias
    assert np.abs(model.margins(pieces) - want).max() < 1e-4
    assert model.margins(["^日本語日"]).tolist() == [model.bias]


def test_a_word_at_the_end_of_a_long_text_counts(model):
    draw = random.Random(8)
    long = " ".join(_text(draw) for _ in range(300))
    assert _predicted(model, [long, long + " blockhead"]).tolist() == [False, True]


def test_rows(spark, model):
    got = T.score(docs_of(spark, AWKWARD), model, keep=("text", "kept", "n_words", "spans"))
    rows = got.collect()
    assert got.columns == ["doc_id", "score", "predicted", "text", "kept", "n_words", "spans"] and len(rows) == len(AWKWARD)
    assert all(0 <= r.score <= 1 and r.predicted == 0 and r.spans == "x" for r in rows)
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(AWKWARD, key=str)
    assert T.score(docs_of(spark, []), model).collect() == []


def test_one_class_gives_zero(spark):
    labelled = spark.createDataFrame([(k, "a b c", 0) for k in range(20)], "doc_id bigint, text string, toxic int")
    model = T.train(labelled.drop("toxic"), labelled.drop("text"), scratch_path(spark, "t"))
    assert {r.score for r in T.score(docs_of(spark, AWKWARD), model).collect()} == {0.0}


def test_kernel_against_a_plain_reckoning():
    def features(word):
        out = {}
        letters = T._ALPHABET[[ord(c) for c in word]].tolist()
        for i in range(len(word)):
            for j in range(i + 1, len(word)):
                for k in range(j + 1, min(len(word), i + T.SPAN)):
                    key = (letters[i] * 64 + letters[j]) * 64 + letters[k]
                    out[key] = out.get(key, 0) + T.DECAY ** (k - i + 1 - T.LETTERS)
        return out

    words = ["^banana", "^ananas", "^bandana", "^xyz", "aaaa"]
    codes, units = T._units(words)
    got = T._kernel(words, codes, units)
    for a, one in enumerate(words):
        for b, two in enumerate(words):
            f, g = features(one), features(two)
            dot = sum(v * g.get(k, 0) for k, v in f.items())
            norm = np.sqrt(sum(v * v for v in f.values()) * sum(v * v for v in g.values()))
            assert abs(got[a, b] - (dot / norm) ** T.POWER) < 1e-5


def test_all_forms_with_letters_put_in(model):
    changed = ["NITWIT!!", "nit-wit", "n.i.t.w.i.t", "blockxhead", "d i m w i t", "scound.rel", "(dimwit),", "b1ockhead",
               "blocxkhzead", "scoxundrzel", "nitwxit", "scounndrel", "blokckhead", "bl0ckhead", "dimw1t"]
    found = _predicted(model, [f"ka lo miter {word} onsa ve" for word in changed])
    assert found.all(), dict(zip(changed, found.tolist()))
    draw = random.Random(3)
    texts = []
    for _ in range(400):
        word = draw.choice(INSULTS)
        for _ in range(2):
            k = draw.randrange(1, len(word))
            word = word[:k] + draw.choice("abcdefghijklmnopqrstuvwxyz") + word[k:]
        texts.append(f"ka lo miter {word} onsa ve")
    assert _predicted(model, texts).mean() > 0.7


def test_the_machine_is_at_the_least_loss():
    """The fitted weights, judged by the loss worked out plainly: no small step makes it smaller."""
    draw = random.Random(12)
    counts = {f"^{_text(draw).split()[0][:6]}a": (draw.choice([0.0, 0.4, 2.0]), draw.choice([0.1, 1.0])) for _ in range(60)}
    landmarks = sorted(counts)[::4]
    fitted = T.fit_machine(counts, landmarks)
    codes, units = T._units(landmarks)
    alike = T._kernel(landmarks, codes, units)
    seen = T._kernel(list(counts), codes, units)

    def loss(weights, bias):
        total = weights @ alike @ weights + 1e-6 * bias * bias
        for row, (toxic, clean) in zip(seen, counts.values()):
            margin = row @ weights + bias
            total += T.COST * (toxic * max(0, 1 - margin) ** 2 + clean * max(0, 1 + margin) ** 2)
        return total

    least = loss(fitted.weights, fitted.bias)
    steps = np.random.default_rng(5)
    for size in (1e-2, 1e-1, 1.0):
        for _ in range(50):
            step = steps.normal(size=len(landmarks) + 1) * size
            assert loss(fitted.weights + step[:-1], fitted.bias + step[-1]) > least - 1e-4 * least


def test_scores_against_a_plain_reckoning(spark, model):
    draw = random.Random(13)
    texts = [_text(draw, [draw.choice(INSULTS)] if k % 3 == 0 else ()) for k in range(30)] + ["", "d i m w i t", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {row.doc_id: row for row in T.score(docs, model).collect()}
    for k, text in enumerate(texts):
        words = (text or "").split()
        if words and all(len(w) == 1 for w in words):
            words.append("".join(words))
        margins = []
        for word in words:
            pieces = T.pieces_of(word)
            margins.append(max((T._kernel(pieces, model.codes, model.units) @ model.weights + model.bias).tolist())
                           if pieces else model.bias)
        worst, strong = max(margins, default=model.bias), sum(m > T.STRONG for m in margins)
        a, b, c = model.scale
        want = 1 / (1 + np.exp(-(a * worst + b * np.log1p(strong) + c)))
        assert abs(got[k].score - want) < 1e-3 and got[k].predicted == int(got[k].score >= T.THRESHOLD)
