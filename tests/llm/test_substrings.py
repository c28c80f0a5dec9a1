import random

from ledgerloom.llm.substrings import remove_repeats
from tests.llm.helpers import AWKWARD, WORDS, docs_of


def _expected(docs, width):
    words = [(d, WORDS.findall(t or "")) for d, t in docs]
    least = {}
    for d, w in words:
        for k in range(len(w) - width + 1):
            if d is not None:
                g = tuple(w[k:k + width])
                least[g] = min(d, least.get(g, d))
    out = []
    for d, w in words:
        gone = set()
        for k in range(len(w) - width + 1):
            if d is not None and least[tuple(w[k:k + width])] < d:
                gone.update(range(k, k + width))
        edges = [k for k in range(len(w) + 1) if (k in gone) != (k - 1 in gone)]
        out.append((d, len(w), len(gone), edges, " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def _got(frame):
    return sorted([(r.doc_id, r.n_words, r.n_removed, list(r.removed), r.kept_text) for r in frame.collect()], key=str)


def test_against_brute_force(spark):
    draw = random.Random(1)
    passage = "p q r s t u é w x y"
    docs = AWKWARD + [(None, passage + " z")]
    for k in range(40):
        parts = [draw.choice("abcdABCD") + draw.choice([" ", "\n", "  ", "\t"]) for _ in range(draw.randint(0, 40))]
        if k % 3 == 0:
            parts.insert(draw.randint(0, len(parts)), f" {passage} ")
        docs.append((draw.randint(6, 30), "".join(parts)))
    docs += [(90, "a b c d " * 5000), (91, "a b c d " * 5000), (92, "\u00a0a\u2003b c d a b"), (93, passage)]
    for width in (3, 13):
        assert _got(remove_repeats(docs_of(spark, docs), width)) == _expected(docs, width)


def test_empty(spark):
    assert remove_repeats(docs_of(spark, [])).collect() == []
