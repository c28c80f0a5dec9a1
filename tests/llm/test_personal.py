import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pyarrow as pa

from ledgerloom.llm import personal as P
from ledgerloom.session import scratch_path
from tests.llm.helpers import AWKWARD, docs_of, small

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    total = 0
    for k, d in enumerate(digits[::-1]):
        d = int(d) * (2 if k % 2 else 1)
        total += d // 10 + d % 10
    return total % 10 == 0


def _base(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    digits = lambda m: "".join(c for c in m.group() if c in "0123456789")
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and _luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def _scan(texts):
    rows = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    return P._scanned(rows).to_pylist()


def test_base_spans_against_plain_patterns():
    draw = random.Random(13)
    pieces = ["a", "Z", "9", "0", "25", "255", "256", ".", ".", "..", "@", "+", "-", "_", "%", " ", " ", "(", ")", "é", "漢", "\n", "x@y.z",
              "1.2.3.4", "+1 (386) 555-3733", "4111 1111 1111 1111", "4111111111111111", "00012.1.1.1", "@@", "a@b.c.d_e@f.g", "5-5"]
    texts = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 30))) for _ in range(4000)]
    for text, row in zip(texts, _scan(texts)):
        assert [(s["kind"], s["start"], s["end"]) for s in row["spans"]] == _base(text), text


def test_long_runs_take_linear_time():
    text = "9" * 300_000 + " " + "a" * 300_000 + " " + "@" * 100_000 + " +" + "(" * 100_000 + " 1.2.3.4 " + "1." * 100_000
    row, = _scan([text])
    assert {s["kind"] for s in row["spans"]} == {"ip"}


BOUNDS = re.compile(r"[^\x20\x09-\x0D\"'()\[\]{}<>,;:=#|]+")


def _brute(docs, rounds=P.ROUNDS):
    """Spans of every document by strings instead of hashes, and loops instead of joins."""
    mentions, grams = [], Counter()
    for k, (_, text) in enumerate(docs):
        text = text or ""
        lexical = [(m.start(), m.end(), small(m.group())) for m in BOUNDS.finditer(text)]
        grams.update(w for _, _, w in lexical)
        grams.update((a[2], b[2]) for a, b in zip(lexical, lexical[1:]))
        found = _base(text)
        for a, b, _ in lexical:
            word = text[a:b].rstrip(".!?-_%/\\*&~")
            b = a + len(word)
            size = len(text[a:b].encode())
            if 6 <= size <= 64 and sum(c in "0123456789" for c in word) >= 4 and not any(s < b and a < e for _, s, e in _base(text)):
                found.append(("context", a, b))
        for kind, a, b in found:
            left = [w for _, e, w in lexical if e <= a]
            right = [w for s, _, w in lexical if s >= b]
            patterns = [("L", left[-1])] if left else []
            patterns += [("L", tuple(left[-2:]))] if len(left) > 1 else []
            patterns += [("R", right[0])] if right else []
            patterns += [("R", tuple(right[:2]))] if len(right) > 1 else []
            mentions.append((k, kind, a, b, small(text[a:b]), patterns))
    edges = Counter((p, m[4]) for m in mentions for p in m[5])
    seeds = {m[4]: 1.0 for m in mentions if m[1] != "context"}
    trust = dict(seeds)
    for _ in range(rounds):
        share, support = defaultdict(float), Counter()
        for (p, i), n in edges.items():
            share[p] += n * trust.get(i, 0.0) / grams[p[1]]
            support[p] += trust.get(i, 0.0) >= 0.5
        confident = {p: min(s, 1 - 1e-9) for p, s in share.items() if support[p] >= 3 and s >= 0.5 - 1e-9}
        doubt = defaultdict(lambda: 1.0)
        for (p, i), _ in edges.items():
            if p in confident and i not in seeds:
                doubt[i] *= 1 - confident[p]
        trust = seeds | {i: 1 - d for i, d in doubt.items()}
    out = []
    for k, (doc_id, text) in enumerate(docs):
        found = sorted((a, b) for j, kind, a, b, i, _ in mentions if j == k and kind == "context" and trust.get(i, 0) >= 0.5)
        out.append((doc_id, _base(text or "") + [("context", a, b) for a, b in found]))
    return sorted(out, key=str)


def _got(frame):
    return sorted([(r.doc_id, [tuple(s) for s in r.spans]) for r in frame.collect()], key=str)


def _corpus(seed):
    draw = random.Random(seed)
    common = [f"w{c}" for c in "abcdefghij"] + ["the", "of", "é"]
    labels = ["Contact:", "member no", "passport =", "order", "card #"]
    rows = []
    for k in range(150):
        parts = [draw.choice(common) for _ in range(draw.randint(5, 30))]
        for _ in range(draw.randint(0, 3)):
            label = draw.choice(labels)
            value = {"Contact:": lambda: draw.choice([f"u{k}@m{draw.randint(1, 9)}.org", f"+49 30 {draw.randint(100000, 999999)}", f"id{draw.randint(10000, 99999)}"]),
                     "member no": lambda: draw.choice([f"1.2.{draw.randint(0, 255)}.4", f"M-{draw.randint(1, 20)}5555"]),
                     "passport =": lambda: draw.choice([f"M-{draw.randint(1, 20)}5555", f"P{draw.randint(10000, 10020)}"]),
                     "order": lambda: f"no{draw.randint(10000, 99999)}",
                     "card #": lambda: "4111 1111 1111 1111"}[label]()
            parts.insert(draw.randint(0, len(parts)), f"{label} {value}")
        if draw.random() < 0.4:
            parts.append("the " + f"u{k}@x.org")
        rows.append((k, " ".join(parts)))
    return rows


def test_against_brute_force(spark):
    for seed in (1, 2):
        docs = AWKWARD + _corpus(seed) + [(3, "Contact: id77777"), (3, "Contact: id77777"), (None, "Contact: id88888 é")]
        for rounds in (1, 3):
            want = _brute(docs, rounds)
            assert _got(P.find_personal(docs_of(spark, docs).repartition(3), scratch_path(spark, "p"), rounds)) == want
        kinds = Counter(kind for _, spans in want for kind, _, _ in spans)
        assert kinds["context"] > 30 and len(kinds) == 5


def test_rounds_spread(spark):
    """A label next to known identifiers finds new ones; where these stand under another label, that one counts as well."""
    docs = [(k, f"text {k}a reach me at u{k}@m.org now") for k in range(4)]
    docs += [(10 + k, f"some{k} words reach me at AB-{k}0000 then") for k in range(3)]
    docs += [(20 + k, f"other{k} key ident AB-{k}0000 and") for k in range(3)] + [(30, "last key ident ZX-91919 or")]
    docs += [(40 + k, f"plain{k} order 12345{k}") for k in range(9)]
    first = dict(_got(P.find_personal(docs_of(spark, docs), scratch_path(spark, "p"), 1)))
    assert first[10] == [("context", 24, 32)] and first[30] == []
    third = dict(_got(P.find_personal(docs_of(spark, docs), scratch_path(spark, "p"), 3)))
    assert third[30] == [("context", 15, 23)] and not any(third[40 + k] for k in range(9))


def test_empty(spark):
    assert P.find_personal(docs_of(spark, []), scratch_path(spark, "p")).collect() == []
    assert _got(P.find_personal(docs_of(spark, AWKWARD), scratch_path(spark, "p"))) == sorted(((d, []) for d, _ in AWKWARD), key=str)


def test_small_tables_are_written_in_few_parts(spark):
    """However many partitions the shuffles have, tables of a few rows need no file for each of them."""
    docs, folder = AWKWARD + _corpus(4), scratch_path(spark, "p")
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key, None) for key in held}
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        found = P.find_personal(docs_of(spark, docs).repartition(3), folder)
        assert _got(found) == _brute(docs)
        assert found.rdd.getNumPartitions() <= 4
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    parts = {table.name: len(list(table.glob("part-*.parquet"))) for table in Path(folder).iterdir()}
    assert len(parts) == 12 and max(parts.values()) <= 4, parts


def test_counts_are_added_up(spark, monkeypatch):
    """Stretches of a task are counted together, and sent on in between where they hold many words."""
    docs = [(k, f"a b{k % 7} a") for k in range(60)]
    grams = spark.createDataFrame([(int(g),) for g in P._Words.of(pa.array(["a b3"])).single], "gram bigint")
    for held in (0, 5, P.HELD_GRAMS):
        monkeypatch.setattr(P, "STRETCH_BYTES", 10)
        monkeypatch.setattr(P, "HELD_GRAMS", held)
        assert sorted(r.total for r in P.gram_totals(docs_of(spark, docs), grams).collect()) == [9, 120]
