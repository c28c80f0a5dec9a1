import random
import re

from ledgerloom.llm import positional as P
from ledgerloom.session import scratch_path
from tests.llm.helpers import AWKWARD, docs_of, small

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _expected(docs, items, width):
    out = []
    for doc_id, text in docs:
        w = WORD.findall(small(text or ""))
        hit, named = set(), set()
        for item, t in items:
            v = WORD.findall(small(t or ""))
            for k in range(max(1, len(v) - width + 1) if v else 0):
                g = v[k:k + width]
                for i in range(len(w) - len(g) + 1):
                    if w[i:i + len(g)] == g:
                        hit.update(range(i, i + len(g)))
                        named.update([] if item is None else [str(item)])
        out.append((doc_id, len(w), len(hit), len(named), sorted(named), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def _got(frame):
    return sorted([(r.doc_id, r.n_words, r.n_hit, r.n_items, list(r["items"]), r.contaminated) for r in frame.collect()],
                  key=str)


def _tables(seed=3):
    draw = random.Random(seed)
    vocabulary = ["a", "b", "C", "dé", "e1", "漢", "g"]
    text = lambda n: "".join(draw.choice(vocabulary) + draw.choice([" ", ", ", "\n", "_", "-"]) for _ in range(n))
    docs = AWKWARD + [(10 + k, text(draw.randint(0, 60))) for k in range(30)] + [(50, text(20_000))]
    items = [(k, text(draw.randint(0, 9))) for k in range(12)] + [
        (100, None), (101, ""), (102, docs[-2][1]), (None, "C dé e1"), (10, text(3)), (9, "one"), (9, "one")]
    return docs, items


def test_against_brute_force(spark, monkeypatch):
    docs, items = _tables()
    items_frame = spark.createDataFrame(items, "item_id bigint, text string")
    want = _expected(docs, items, 4)
    found = P.contamination(docs_of(spark, docs), items_frame, scratch_path(spark, "p"), width=4)
    assert _got(found) == want
    monkeypatch.setattr(P, "BLOCK_WORDS", 8)
    found = P.contamination(docs_of(spark, docs), items_frame, scratch_path(spark, "p"), width=4)
    assert _got(found) == want


def test_near_by(spark):
    docs, items = _tables(8)
    docs, items = docs[:30], [(k, t) for k, t in items[:8]]
    found = P.contamination(docs_of(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"),
                            scratch_path(spark, "p"), width=4, slop=2)
    for row in found.collect():
        w = WORD.findall(small(next((t for d, t in docs if d == row.doc_id), None) or ""))
        near = set()
        for item, t in items:
            v = WORD.findall(small(t or ""))
            for k in range(max(1, len(v) - 3) if v else 0):
                g = v[k:k + 4]
                near.update([str(item)] if any(set(g) <= set(w[i:i + len(g) + 2]) for i in range(len(w))) else [])
        assert row.near_items == sorted(near - set(row["items"]))


def test_empty_tables(spark):
    docs, items = _tables()
    no_items = spark.createDataFrame([], "item_id bigint, text string")
    got = _got(P.contamination(docs_of(spark, docs), no_items, scratch_path(spark, "p")))
    assert len(got) == len(docs) and not any(r[-1] or r[2] or r[3] for r in got)
    assert _got(P.contamination(docs_of(spark, []), no_items, scratch_path(spark, "p"))) == []


def test_repeated_documents_in_several_files_and_stretches(spark, monkeypatch):
    """The same documents in several files and stretches, and a benchmark of many blocks: no row is lost or told twice."""
    docs, items = _tables(21)
    docs = docs[:25]
    items_frame = spark.createDataFrame(items, "item_id bigint, text string")
    path = scratch_path(spark, "copies")
    for _ in range(3):
        docs_of(spark, docs).coalesce(1).write.mode("append").parquet(path)
    docs_of(spark, docs + docs).coalesce(1).write.mode("append").parquet(path)
    monkeypatch.setattr(P, "BLOCK_WORDS", 8)
    monkeypatch.setattr(P, "STRETCH_BYTES", 200)
    found = P.contamination(spark.read.parquet(path), items_frame, scratch_path(spark, "p"), width=4)
    assert _got(found) == sorted(_expected(docs, items, 4) * 5, key=str)


def test_the_driver_holds_one_block(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_WORDS", 100)
    items = spark.range(2000).selectExpr("id AS item_id", "concat('word', id, ' and ', id, ' more ', id)  AS text")
    sizes = [sum(len(P.words_of(t)) for _, t in block) for block in P.blocks_of(items, scratch_path(spark, "p"))]
    assert sum(sizes) == 2000 * 5 and len(sizes) == 100 and max(sizes) < 300
