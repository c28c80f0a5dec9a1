"""Removal of repeated passages by Rabin-Karp hashes of every window of words.

Documents are dealt into groups by a hash. A group hashes all windows of its documents; a window that an
earlier document of the same group has as well is settled there. What is left, one set of places for each
distinct window, goes to the bucket of its hash, where windows of all groups are counted and every place
behind the smallest document is marked. The marks return to the groups, which already hold the texts, and
merge there into maximal intervals. Texts cross the network once, packed; a very frequent passage adds one
entry for each group, so no bucket grows with the number of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words

WIDTH = 13
# Groups and buckets for each shuffle partition, both rounded to powers of two. A group sends one row to each
# bucket, so the rows grow with the product: few of them, as large as a task's memory allows.
GROUPS_PER_PARTITION = 2
BUCKETS_PER_PARTITION = 1

# Ranges of hashes that a bucket is worked through in, which bounds the arrays made on the way.
RANGES = 8

ENTRY_SCHEMA = "bucket int, part int, hashes binary, places binary, docs binary, marks binary"
MARK_SCHEMA = "part int, marks binary"
OUT_SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, removed array<int>, kept_text string"


def _planes(values: np.ndarray) -> bytes:
    """The bytes of the values by significance, which lets the shuffle's compression find the equal ones."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()


def _from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(_planes(values))


def _unpack(data: bytes, kind: type) -> np.ndarray:
    return _from_planes(zstandard.ZstdDecompressor().decompress(data), kind)


class _Group:
    """The documents of one group in a fixed order, with their words."""

    def __init__(self, table: pa.Table) -> None:
        plain = zstandard.ZstdDecompressor()
        ids = table.column("doc_id").to_pylist()
        texts = [None if z is None else plain.decompress(z) for z in table.column("packed").to_pylist()]
        # Rows without an id stand last; they neither lose passages nor make others lose them.
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0, texts[k] is not None, texts[k] or b""))
        self.ids = [ids[k] for k in order]
        self.texts = [texts[k] or b"" for k in order]
        self.named = sum(x is not None for x in ids)
        self.data, self.offsets = words.buffers(
            pa.array(self.texts, pa.large_binary()).cast(pa.large_string()), words.PLAIN_WORDS)
        self.starts, self.ends, self.counts = words.word_bounds(self.data, self.offsets)
        self.begins = np.cumsum(self.counts) - self.counts


def _runs(places: np.ndarray) -> np.ndarray:
    """Sorted places as (first, behind last) of each unbroken run, one after the other."""
    if not len(places):
        return np.empty(0, np.int32)
    cut = np.flatnonzero(np.diff(places) > 1)
    first = np.concatenate([[0], cut + 1])
    last = np.concatenate([cut, [len(places) - 1]])
    return np.stack([places[first], places[last] + 1], axis=1).astype(np.int32).reshape(-1)


def _entries(part: int, group: _Group, width: int, buckets: int) -> pa.Table:
    named = group.counts[:group.named]
    n = int(named.sum())
    hashes, places = words.window_hashes(
        words.word_hashes(group.data, group.starts[:n], group.ends[:n]), named, width)
    order = np.argsort(hashes, kind="stable")
    hashes, places = hashes[order], places[order].astype(np.int32)
    # Equal ids count as one document: the rank of an id among the group's distinct ones.
    ids = np.asarray(group.ids[:group.named], np.int64)
    rank = np.cumsum(np.diff(ids, prepend=ids[:1]) != 0).astype(np.int32)
    owner = np.searchsorted(group.begins[:group.named], places, side="right") - 1
    # A text without words begins where the next one does; the search has to land on the one with the words.
    own_rank = rank[owner] if len(places) else np.empty(0, np.int32)
    head = np.concatenate([[True], hashes[1:] != hashes[:-1]])[:len(hashes)]
    least = own_rank[head][np.cumsum(head) - 1] if len(hashes) else own_rank
    later = own_rank > least
    marks = _runs(np.sort(places[later]))
    hashes, places = hashes[~later], places[~later]
    filled = named > 0
    docs = np.stack([group.begins[:group.named][filled], ids[filled]], axis=1).astype(np.int64).reshape(-1)
    docs_packed = _pack(docs)
    bits = np.uint64(64 - (buckets.bit_length() - 1))
    bounds = np.searchsorted((hashes >> bits).astype(np.int64) if buckets > 1 else np.zeros(len(hashes), np.int64),
                             np.arange(buckets + 1))
    rows = [(b, part, _planes(hashes[low:high]), _planes(places[low:high]), docs_packed, None)
            for b, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])) if high > low]
    if len(marks):
        rows.append((part % buckets, part, None, None, None, _pack(marks)))
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 4
    names = [name.split()[0] for name in ENTRY_SCHEMA.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names)


def _marks(table: pa.Table) -> pa.Table:
    """Places of one bucket's windows that a smaller document has too, as runs for each group."""
    rows: list[tuple[int, bytes]] = []
    sent: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
    columns = [table.column(c).combine_chunks() for c in table.column_names]
    for k in range(table.num_rows):
        part, h, p, d, m = (column[k] for column in columns[1:])
        if m.is_valid:
            rows.append((part.as_py(), m.as_py()))
        else:
            sent.append((part.as_py(), _from_planes(h.as_buffer(), np.uint64), _from_planes(p.as_buffer(), np.int32),
                         _unpack(d.as_buffer(), np.int64).reshape(-1, 2)))
    del columns
    if sent:
        # Every fragment is in the order of its hashes, so a range of hashes is a slice of each.
        low, high = min(int(h[0]) for _, h, _, _ in sent), max(int(h[-1]) for _, h, _, _ in sent)
        edges = np.array([low + (high - low) * k // RANGES for k in range(1, RANGES)], np.uint64)
        cuts = [np.concatenate([[0], np.searchsorted(h, edges, side="right"), [len(h)]]) for _, h, _, _ in sent]
        found = [_late(sent, [(c[k], c[k + 1]) for c in cuts]) for k in range(RANGES)]
        g, p = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((p, g))
        g, p = g[order], p[order]
        for part, low, high in zip(*(x.tolist() for x in _pieces(g))):
            rows.append((part, _pack(_runs(p[low:high]))))
    columns = list(zip(*rows)) if rows else [[], []]
    return pa.table([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary())], names=["part", "marks"])


def _late(sent: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]],
          slices: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(group, place) of the windows in these slices of the fragments that a smaller document has too."""
    h = np.concatenate([hashes[a:b] for (_, hashes, _, _), (a, b) in zip(sent, slices)])
    if not len(h):
        return np.empty(0, np.int32), np.empty(0, np.int32)
    p = np.concatenate([places[a:b] for (_, _, places, _), (a, b) in zip(sent, slices)])
    o = np.concatenate([docs[np.searchsorted(docs[:, 0], places[a:b], side="right") - 1, 1]
                        for (_, _, places, docs), (a, b) in zip(sent, slices)])
    g = np.repeat(np.array([part for part, *_ in sent], np.int32), [b - a for a, b in slices])
    order = np.argsort(h, kind="stable")
    h, o = h[order], o[order]
    heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    least = np.repeat(np.minimum.reduceat(o, heads), np.diff(np.append(heads, len(h))))
    late = order[o > least]
    return g[late], p[late]


def _pieces(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, from, to) of each run of equal sorted keys."""
    if not len(keys):
        return keys, keys, keys
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[heads], heads, np.append(heads[1:], len(keys))


def _result(group: _Group, marks: list[bytes], width: int) -> pa.Table:
    n = int(group.counts.sum())
    change = np.zeros(n + width + 1, np.int32)
    for packed in marks:
        runs = _unpack(packed, np.int32).reshape(-1, 2)
        np.add.at(change, runs[:, 0], 1)
        np.add.at(change, runs[:, 1] + width - 1, -1)
    gone = np.cumsum(change[:n]) > 0
    out = []
    for k, (doc, text) in enumerate(zip(group.ids, group.texts)):
        own = gone[group.begins[k]:group.begins[k] + group.counts[k]]
        parts = text.split()
        if own.any():
            edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
            parts = [word for word, out_ in zip(parts, own.tolist()) if not out_]
            out.append((doc, len(own), int(own.sum()), edges.tolist(), b" ".join(parts)))
        else:
            out.append((doc, len(own), 0, [], b" ".join(parts)))
    columns = list(zip(*out)) if out else [[]] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary()]
    names = ["doc_id", "n_words", "n_removed", "removed", "kept_text"]
    table = pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=names)
    return table.set_column(4, "kept_text", table.column(4).cast(pa.string()))


def _power(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (word places begin, end, begin, ...; maximal
    and apart), kept_text (the words left, joined by one space).

    A word goes if it lies in a window of ``width`` words that also begins in a document with a smaller id.
    Null texts have no words. Rows with equal ids do not remove each other's words; rows without an id
    neither lose words nor make others lose them. Windows are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = _power(partitions * GROUPS_PER_PARTITION)
    buckets = _power(partitions * BUCKETS_PER_PARTITION)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                packed = [None if t is None else packer.compress(t.encode()) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(packed, pa.binary())],
                                                 ["part", "doc_id", "packed"])

    keyed = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    keyed = keyed.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int").alias("part"), "doc_id", "text")
    dealt = keyed.mapInArrow(pack, "part int, doc_id bigint, packed binary").repartition(partitions, "part")

    def entries(key: tuple, table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        return _entries(key[0].as_py(), _Group(table), width, buckets)

    def marks(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        return _marks(table)

    def result(table: pa.Table, marked: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        return _result(_Group(table), marked.column("marks").to_pylist(), width)

    sent = dealt.groupBy("part").applyInArrow(entries, ENTRY_SCHEMA)
    marked = sent.groupBy("bucket").applyInArrow(marks, MARK_SCHEMA)
    return dealt.groupBy("part").cogroup(marked.groupBy("part")).applyInArrow(result, OUT_SCHEMA)
