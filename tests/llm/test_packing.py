import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing, tokens
from ledgerloom.llm.queries import tokenizer_path
from tests.llm.helpers import AWKWARD, docs_of

ODD = ["It's <|endoftext|> we're <|startoftext|>x", "İstanbul ŞIŞ ﬁ K Å e\u0301 don't", "a\u00a0b\u2003c\x1cd", "漢字 かな 123 4.5",
       "&&& x*** y%%% z'''", "…,–—", "x<|y", "'s 't", "\u0301 mark", "naïve.,.;", "a" * 3000, "A.B.C. U.S.A!"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_those_of_the_whole_text(tokenizer):
    json = open(tokenizer_path()).read()
    texts = ODD + [None, ""] + pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:60]
    ids, lengths, stops = tokens.encode_texts(json, pa.array(texts), 2)
    cuts = np.cumsum(lengths)
    for text, end, n in zip(texts, cuts, lengths):
        assert ids[end - n:end].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    assert set(stops.tolist()) <= set(range(len(ids) + 1))


def _cost(cuts, penalties, size):
    cost, low = 0, 0
    for cut in cuts:
        n = cut - low
        if n > size:
            return None
        pad = 0 if n in packing.SHORT_POWERS else size - n
        cost, low = cost + pad + penalties[cut] + packing.SEQUENCE_PRICE, cut
    return cost


def test_cuts_cost_least(monkeypatch):
    monkeypatch.setattr(packing, "SHORT_POWERS", (4, 8))
    draw = random.Random(5)
    for _ in range(60):
        total = draw.randint(1, 40)
        places = sorted({total, *range(8, total, 8), *draw.sample(range(1, total + 1), min(total, draw.randint(1, 8)))})
        penalties = {p: draw.choice([0, 8, 64]) for p in places}
        got = packing.best_cuts(np.array(places), np.array([penalties[p] for p in places]), 16)
        best = None
        inner = places[:-1]
        for mask in range(1 << len(inner)):
            cost = _cost([p for k, p in enumerate(inner) if mask >> k & 1] + [total], penalties, 16)
            if cost is not None and (best is None or cost < best):
                best = cost
        assert _cost(got, penalties, 16) == best and got[-1] == total


def test_last_window_splits_where_it_pays():
    assert packing.split_last(0, 4096, 4096) == [4096]
    assert packing.split_last(10, 10 + 2048 + 512, 4096) == [10 + 2048, 10 + 2560]
    assert packing.split_last(0, 4095, 4096) == [4095]


def test_every_id_once(spark, tokenizer):
    rows = [(k, t) for k, t in AWKWARD] + [(100 + k, t) for k, t in enumerate(ODD)] + [
        (200, "word " * 20_000), (201, "One two. Three four! " * 3000)]
    got = packing.pack_documents(docs_of(spark, rows).coalesce(1), tokenizer_path(), 2, size=1024, segment_tokens=9000,
                                  stretch_bytes=4000).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        pieces = sorted(by_doc[doc_id], key=lambda r: r.start)
        copies = sum(d == doc_id for d, _ in rows)
        assert sum(r.length for r in pieces) == copies * len(ids)
        for r in pieces:
            assert r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes())
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding, total = padding + packing.padding(at, 1024), total + at
    assert padding < 0.02 * total
    assert packing.pack_documents(docs_of(spark, []), tokenizer_path(), 2).collect() == []
