"""Distributed positional inverted index of training texts, and phrase search in it.

The index is a table with one row per stretch of documents: the stretch's distinct words in order, and for
each its posting list, the places where it stands, as differences. A document's postings lie in one row,
so lists are intersected where they are stored. Test phrases are searched from their rarest word, by the
word counts of the whole index: its list, moved by the word's offset in the phrase, gives the starts, which
the lists of the next rarer words thin out until none are left or all words have matched.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import tokens, words

WIDTH = 13
LEAST_SHARE = 20  # contaminated from one hit word in this many on
STRETCH_BYTES = 8 << 20
# Test words that one search takes at a time, about: items are dealt into blocks by a hash.
BLOCK_WORDS = 50_000

INDEX_SCHEMA = "shard string, doc_ids array<bigint>, n_words array<int>, terms binary, counts binary, places binary"
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_FOLD))


def _pack(values: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values if isinstance(values, bytes) else values.tobytes())


def _unpack(value: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all words of ``docs``; write it out and search what was written.

    Documents follow each other with one empty place between them, which no phrase can match across.
    Null and empty texts have no postings but keep their place in doc_ids. ``shard`` is drawn when a row is made: it tells
    rows with equal documents apart, once the index is written.
    """
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, count in tokens.stretches(batch.column(1), STRETCH_BYTES):
                part = batch.slice(low, count)
                data, offsets = words.buffers(part.column(1), words.ALPHANUMERIC_WORDS)
                starts, ends, per_text = words.word_bounds(data, offsets)
                coded = words.word_array(data, starts, ends).dictionary_encode()
                rank = np.empty(len(coded.dictionary), np.int64)
                rank[pc.sort_indices(coded.dictionary).to_numpy(zero_copy_only=False)] = np.arange(len(rank))
                terms = rank[coded.indices.to_numpy(zero_copy_only=False)]
                order = np.argsort(terms, kind="stable")
                places = np.arange(len(terms)) + np.repeat(np.arange(count), per_text)
                counts = np.bincount(terms, minlength=len(rank)).astype(np.int32)
                moved = places[order]
                steps = np.diff(moved, prepend=0)
                heads = np.cumsum(counts) - counts
                steps[heads] = moved[heads]
                names = "\n".join(coded.dictionary.take(pc.sort_indices(coded.dictionary)).to_pylist()).encode()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uuid.uuid4().hex]), pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                     pa.array([per_text.astype(np.int32)], pa.list_(pa.int32())), pa.array([_pack(names)], pa.binary()),
                     pa.array([_pack(counts)], pa.binary()), pa.array([_pack(steps.astype(np.int32))], pa.binary())],
                    ["shard", "doc_ids", "n_words", "terms", "counts", "places"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(build, INDEX_SCHEMA)


@dataclass
class Phrases:
    """Distinct windows of a block of items, as places in ``vocabulary``; ``items[k]`` has the items of window k."""
    vocabulary: list[str]
    windows: list[tuple[int, ...]]
    items: list[list[str]]


def phrases_of(items: Iterable[tuple[object, str | None]], width: int = WIDTH) -> Phrases:
    """Windows of ``width`` words of (item_id, text); a shorter text with words is one window of its own.

    Texts without words have no windows. The windows of an item without an id mark words, but name no item.
    """
    found: dict[tuple[str, ...], set[str]] = defaultdict(set)
    for item_id, text in items:
        own = words_of(text)
        for k in range(max(1, len(own) - width + 1) if own else 0):
            window = found[tuple(own[k:k + width])]
            if item_id is not None:
                window.add(str(item_id))
    vocabulary = sorted({word for window in found for word in window})
    place = {word: k for k, word in enumerate(vocabulary)}
    return Phrases(vocabulary, [tuple(place[w] for w in window) for window in found],
                   [sorted(names) for names in found.values()])


def blocks_of(benchmark: DataFrame, folder: str, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple]]:
    """The items in blocks of about BLOCK_WORDS words, dealt by a hash and written below ``folder``, read one at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    n = items.agg(F.sum(F.regexp_count("text", F.lit(_ANY_CASE)))).first()[0] or 0
    blocks = -(-n // BLOCK_WORDS)
    if not blocks:
        return
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    dealt.repartition("block").write.partitionBy("block").parquet(f"{folder}/benchmark")
    written = spark.read.parquet(f"{folder}/benchmark")
    for block in range(blocks):
        found = [tuple(row) for row in written.where(F.col("block") == block).select("item", "text").collect()]
        if found:
            yield found


class _Shard:
    """One row of the index, opened for the words of a vocabulary."""

    def __init__(self, row: dict, vocabulary: pa.Array, longest: int) -> None:
        self.n_words = np.asarray(row["n_words"], np.int64)
        self.begins = np.cumsum(self.n_words + 1) - self.n_words - 1
        counts = np.frombuffer(_unpack(row["counts"]), np.int32).astype(np.int64)
        size = int(self.n_words.sum()) + len(self.n_words)
        # Forward view for checks at single places: the vocabulary's words, -1 elsewhere and between documents.
        self.at = np.full(size + longest, -1, np.int32)
        self.lists: dict[int, np.ndarray] = {}
        if not len(counts):
            return
        terms = pa.array(_unpack(row["terms"]).decode().split("\n"), pa.string())
        steps = np.frombuffer(_unpack(row["places"]), np.int32)
        ends = np.cumsum(counts)
        known = pc.index_in(terms, value_set=vocabulary)
        for k in np.flatnonzero(known.is_valid().to_numpy(zero_copy_only=False)).tolist():
            term = known[k].as_py()
            self.lists[term] = np.cumsum(steps[ends[k] - counts[k]:ends[k]], dtype=np.int64)
            self.at[self.lists[term]] = term

    def exact(self, window: tuple[int, ...], order: list[int]) -> np.ndarray:
        """Places where the window begins; ``order`` has its offsets from the rarest word on."""
        first = self.lists.get(window[order[0]])
        if first is None:
            return np.empty(0, np.int64)
        starts = first - order[0]
        starts = starts[starts >= 0]
        for offset in order[1:]:
            if not len(starts):
                break
            starts = starts[self.at[starts + offset] == window[offset]]
        return starts

    def near(self, window: tuple[int, ...], order: list[int], slop: int) -> np.ndarray:
        """Places of the rarest word with all words of the window in some stretch of len(window) + slop words
        of one document around it, in any order."""
        span = len(window) + slop
        distinct = list(dict.fromkeys(window[k] for k in order))
        anchors = self.lists.get(distinct[0])
        if anchors is None:
            return np.empty(0, np.int64)
        for term in distinct[1:]:
            places = self.lists.get(term)
            if places is None or not len(anchors):
                return np.empty(0, np.int64)
            at = np.searchsorted(places, anchors)
            left = np.abs(anchors - places[np.maximum(at - 1, 0)])
            right = np.abs(places[np.minimum(at, len(places) - 1)] - anchors)
            anchors = anchors[np.minimum(left, right) < span]
        docs = np.searchsorted(self.begins, anchors, side="right") - 1
        wanted = np.array(distinct)
        kept = []
        for anchor, doc in zip(anchors.tolist(), docs.tolist()):
            low = max(int(self.begins[doc]), anchor - span + 1)
            high = min(int(self.begins[doc] + self.n_words[doc]), anchor + span)
            for start in range(low, max(low, min(anchor, high - span)) + 1):
                if np.isin(wanted, self.at[start:min(start + span, high)]).all():
                    kept.append(anchor)
                    break
        return np.asarray(kept, np.int64)


def _orders(phrases: Phrases, frequency: dict[str, int]) -> list[list[int]]:
    """Offsets of each window from its rarest word on; the words that stand nowhere come first."""
    count = [frequency.get(word, 0) for word in phrases.vocabulary]
    return [sorted(range(len(w)), key=lambda k: (count[w[k]], k)) for w in phrases.windows]


def frequencies(index: DataFrame, phrases: Phrases) -> dict[str, int]:
    """Occurrences of the phrases' words in the whole index; no more rows than the phrases have words."""
    vocabulary = pa.array(phrases.vocabulary, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, counts in zip(batch.column(0), batch.column(1)):
                names = _unpack(terms.as_py())
                if names:
                    known = pc.index_in(pa.array(names.decode().split("\n"), pa.string()), value_set=vocabulary)
                    mask = known.is_valid().to_numpy(zero_copy_only=False)
                    total[known.drop_null().to_numpy()] += np.frombuffer(_unpack(counts.as_py()), np.int32)[mask]
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total), pa.int64()), pa.array(total[total > 0])],
                                         ["term", "n"])

    rows = (index.select("terms", "counts").mapInArrow(count, "term bigint, n bigint")
            .groupBy("term").agg(F.sum("n").alias("n")).collect())
    return {phrases.vocabulary[row.term]: row.n for row in rows}


MATCH_SCHEMA = "shard string, row int, ranges array<int>, items array<string>, near_items array<string>"


def search(index: DataFrame, phrases: Phrases, slop: int | None = None) -> DataFrame:
    """One row per document with a match: its hit words as merged ranges (begin, end, begin, ...), the items
    with an exact window in it, and with ``slop`` the other items with a window near by.

    (shard, row) is the document's place in the index.
    """
    orders = _orders(phrases, frequencies(index, phrases))
    vocabulary = pa.array(phrases.vocabulary, pa.string())
    windows, items = phrases.windows, phrases.items
    longest = max(map(len, windows), default=0)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                shard = _Shard(row, vocabulary, longest)
                size = len(shard.at)
                change = np.zeros(size + 1, np.int32)
                named: dict[int, set[str]] = defaultdict(set)
                nearby: dict[int, set[str]] = defaultdict(set)
                for window, names, order in zip(windows, items, orders):
                    starts = shard.exact(window, order)
                    if len(starts):
                        np.add.at(change, starts, 1)
                        np.add.at(change, starts + len(window), -1)
                        for doc in np.unique(np.searchsorted(shard.begins, starts, side="right") - 1).tolist():
                            named[doc].update(names)
                    if slop is not None:
                        found = shard.near(window, order, slop)
                        for doc in np.unique(np.searchsorted(shard.begins, found, side="right") - 1).tolist():
                            nearby[doc].update(names)
                hit = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]])
                edges = np.flatnonzero(np.diff(hit))
                owner = np.searchsorted(shard.begins, edges[::2], side="right") - 1
                cuts = np.searchsorted(owner, np.arange(len(shard.begins) + 1)) * 2
                ranges = [(edges[cuts[d]:cuts[d + 1]] - shard.begins[d]).astype(np.int32)
                          for d in range(len(shard.begins))]
                met = [d for d in range(len(ranges)) if len(ranges[d]) or d in nearby]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * len(met), pa.string()), pa.array(met, pa.int32()),
                     pa.array([ranges[d] for d in met], pa.list_(pa.int32())),
                     pa.array([sorted(named.get(d, ())) for d in met], pa.list_(pa.string())),
                     pa.array([sorted(nearby.get(d, set()) - named.get(d, set())) for d in met], pa.list_(pa.string()))],
                    ["shard", "row", "ranges", "items", "near_items"])

    return index.mapInArrow(find, MATCH_SCHEMA)


def _merged(parts: DataFrame) -> DataFrame:
    """One row per document with a match, from the rows of all blocks."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ranges in batch.column("ranges").to_pylist():
                merged: list[int] = []
                for begin, end in sorted(zip(ranges[::2], ranges[1::2])):
                    if merged and begin <= merged[-1]:
                        merged[-1] = max(merged[-1], end)
                    else:
                        merged += [begin, end]
                out.append(merged)
            yield batch.set_column(batch.schema.get_field_index("ranges"), "ranges",
                                   pa.array(out, pa.list_(pa.int32())))

    def together(name: str):
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))).alias(name)

    grouped = parts.groupBy("shard", "row").agg(
        F.flatten(F.collect_list("ranges")).alias("ranges"), together("items"), together("near_items"))
    return grouped.mapInArrow(merge, MATCH_SCHEMA).withColumn(
        "near_items", F.array_except("near_items", "items"))


def contamination(docs: DataFrame, benchmark: DataFrame, folder: str, width: int = WIDTH, slop: int | None = None,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_hit (words inside an occurring window), n_items, items (sorted
    as strings), near_items (empty without ``slop``), contaminated (n_hit > 0 and 20 n_hit >= n_words).

    The index and the matches of each block of items are written below ``folder``, which all executors share; the
    driver holds one block. Documents without text have no words and are clean; without items every document is clean;
    rows with equal or null ids stay apart, wherever in the table they lie.
    """
    spark = docs.sparkSession
    build_index(docs, id_col, text_col).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    matches = spark.createDataFrame([], MATCH_SCHEMA)
    matches.write.parquet(f"{folder}/matches")
    for block in blocks_of(benchmark, folder, item_col, item_text_col):
        search(index, phrases_of(block, width), slop).write.mode("append").parquet(f"{folder}/matches")
    matches = _merged(spark.read.schema(MATCH_SCHEMA).parquet(f"{folder}/matches"))
    n_hit = F.aggregate(F.sequence(F.lit(0), F.size("ranges")), F.lit(0).cast("bigint"), lambda s, k: s + F.when(
        k >= F.size("ranges"), 0).otherwise(F.element_at("ranges", k + 1) * F.when(k % 2 == 0, -1).otherwise(1)))
    every = index.select("shard", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("row", "doc")).select(
        "shard", "row", F.col("doc.doc_ids").alias("doc_id"), F.col("doc.n_words").cast("bigint").alias("n_words"))
    names = F.array().cast("array<string>")
    found = every.join(matches.withColumn("n_hit", n_hit), ["shard", "row"], "left").withColumns({
        "n_hit": F.coalesce("n_hit", F.lit(0).cast("bigint")),
        "items": F.coalesce("items", names), "near_items": F.coalesce("near_items", names)})
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), "items", "near_items",
        ((F.col("n_hit") > 0) & (F.col("n_hit") * LEAST_SHARE >= F.col("n_words"))).alias("contaminated"))
