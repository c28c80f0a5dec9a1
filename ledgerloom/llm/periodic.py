"""Maximal periodic runs of words by a Kruskal pass over suffixes in order of falling common prefixes.

The suffixes of a text are sorted by prefix doubling. Neighbours in that order are the edges, their common
prefix (LCP) the weight. Edges are taken from the longest prefix down; a union-find joins the classes of
suffixes that begin alike, and every class keeps its positions in order. Where a union makes two positions
neighbours whose distance is no more than the LCP, the words from the first position on repeat with that
distance: a seed. Of a run with at least four periods the first position and the one a period later become
neighbours exactly when their LCP is reached, because no position between them can begin alike; a longer distance
with a shorter period inside never makes neighbours. So the seeds with equal end and period are one run, which
starts at the least of them, and periods are always the smallest ones.

A run of at least LEAST_WORDS words and four periods has an LCP of at least five words, so texts without a repeated window of
five words are done without sorting and lower edges are not taken.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import tokens, words

LEAST_WORDS = 6
LEAST_PERIODS = 4
# Common words of the first two of a run's periods at least: LEAST_WORDS - 1 for period 1, more for all others.
LEAST_LCP = LEAST_WORDS - 1
STRETCH_BYTES = 4 << 20
BLOCK = 2048

RUN_SCHEMA = ("doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
              "collapsed_text string")
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class _Places:
    """An ordered set of positions in blocks, so that an insertion moves no more than one block."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, first: int) -> None:
        self.blocks = [[first]]
        self.firsts = [first]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, place: int) -> None:
        at = max(0, bisect_right(self.firsts, place) - 1) if len(self.firsts) > 1 else 0
        block = self.blocks[at]
        k = bisect_left(block, place)
        block.insert(k, place)
        if not k:
            self.firsts[at] = place
        if len(block) > BLOCK:
            half = len(block) // 2
            self.blocks.insert(at + 1, block[half:])
            self.firsts.insert(at + 1, block[half])
            del block[half:]
        self.size += 1

    def around(self, place: int) -> tuple[int, int]:
        """The positions before and after one of the set; -1 where there is none."""
        at = bisect_right(self.firsts, place) - 1 if len(self.firsts) > 1 else 0
        block = self.blocks[at]
        k = bisect_left(block, place)
        before = block[k - 1] if k else self.blocks[at - 1][-1] if at else -1
        after = block[k + 1] if k + 1 < len(block) else self.blocks[at + 1][0] if at + 1 < len(self.blocks) else -1
        return before, after


def suffix_edges(codes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, place, LCP) of neighbours among the sorted suffixes of each text, LCP falling, LEAST_LCP at least.

    ``codes`` tell the words of all texts apart, ``owner`` has the text of each word, rising.
    """
    n = len(codes)
    order = np.lexsort((codes, owner))
    levels = [_dense(order, (np.diff(codes[order]) != 0) | (np.diff(owner[order]) != 0))]
    width = 1
    while True:
        rank = levels[-1]
        shared = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        if not len(shared):
            break
        # What follows behind the text's end is -1; a suffix shorter than the width is alone in its class anyway.
        follow = np.full(n, -1, np.int64)
        inside = shared[shared + width < n]
        inside = inside[owner[inside] == owner[inside + width]]
        follow[inside] = rank[inside + width]
        # Ranks are the place of a class's first suffix in the order: only classes of several are sorted anew.
        part = shared[np.argsort(rank[shared].astype(np.int64) * (n + 1) + follow[shared] + 1, kind="stable")]
        head = np.concatenate([[True], (rank[part[1:]] != rank[part[:-1]]) | (follow[part[1:]] != follow[part[:-1]])])
        first = np.concatenate([[True], rank[part[1:]] != rank[part[:-1]]])
        begin = np.flatnonzero(first)
        within = np.arange(len(part)) - np.repeat(begin, np.diff(np.append(begin, len(part))))
        place = rank[part] + within
        finer = rank.copy()
        finer[part] = place[np.flatnonzero(head)][np.cumsum(head) - 1]
        levels.append(finer)
        width *= 2
    final = levels[-1]
    sorted_places = np.empty(n, np.int64)
    sorted_places[final] = np.arange(n)
    a, b = sorted_places[:-1], sorted_places[1:]
    alike = owner[a] == owner[b]
    # Suffixes that share their first word only are no edges.
    alike &= levels[0][a] == levels[0][b]
    a, b = a[alike], b[alike]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        padded = np.append(levels[k], -1)
        lcp += (padded[a + lcp] == padded[b + lcp]).astype(np.int64) << k
    kept = np.flatnonzero(lcp >= LEAST_LCP)
    kept = kept[np.argsort(-lcp[kept], kind="stable")]
    return a[kept], b[kept], lcp[kept]


def _dense(order: np.ndarray, changes: np.ndarray) -> np.ndarray:
    """Per place the first position of its class in ``order``."""
    heads = np.concatenate([[0], np.flatnonzero(changes) + 1])
    rank = np.empty(len(order), np.int32)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, len(order))))
    return rank


def kruskal_runs(a: np.ndarray, b: np.ndarray, lcp: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, from suffix edges in order of falling LCP."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    places = nodes.tolist()
    parent = list(range(len(places)))
    sets: dict[int, _Places] = {}
    starts: dict[tuple[int, int], int] = {}

    def seed(first: int, second: int, common: int) -> None:
        period = second - first
        if period * (LEAST_PERIODS - 1) <= common and period + common >= LEAST_WORDS:
            key = (second + common, period)
            if starts.get(key, second) > first:
                starts[key] = first

    for x, y, common in zip(ends[:len(a)].tolist(), ends[len(a):].tolist(), lcp.tolist()):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        while parent[y] != y:
            parent[y] = y = parent[parent[y]]
        large, small = sets.pop(x, None), sets.pop(y, None)
        large, small = large or _Places(places[x]), small or _Places(places[y])
        if large.size < small.size:
            x, y, large, small = y, x, small, large
        parent[y] = x
        sets[x] = large
        joined = list(small)
        for place in joined:
            large.add(place)
        for k, place in enumerate(joined):
            before, after = large.around(place)
            if before >= 0 and (not k or before != joined[k - 1]):
                seed(before, place, common)
            if after >= 0 and (k + 1 == len(joined) or after != joined[k + 1]):
                seed(place, after, common)
    return sorted((first, end - first, period) for (end, period), first in starts.items())


def _suspects(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Texts in which some window of LEAST_LCP words stands twice."""
    windows, places = words.window_hashes(hashes, counts, LEAST_LCP)
    owner = np.repeat(np.arange(len(counts)), np.maximum(counts - LEAST_LCP + 1, 0))
    keys = words.mixed(windows + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return np.unique(owner[twice[at] == keys])


def find_runs(hashes: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of several texts; starts count the words of all of them."""
    suspects = _suspects(hashes, counts)
    if not len(suspects):
        return []
    begins = np.cumsum(counts) - counts
    sizes = counts[suspects]
    own = np.cumsum(sizes) - sizes
    chosen = np.repeat(begins[suspects] - own, sizes) + np.arange(int(sizes.sum()))
    codes = hashes[chosen].view(np.int64)
    runs = kruskal_runs(*suffix_edges(codes, np.repeat(np.arange(len(suspects)), sizes)))
    return [(int(chosen[start]), length, period) for start, length, period in runs]


def _described(part: pa.RecordBatch) -> pa.RecordBatch:
    texts = part.column(1)
    data, offsets = words.buffers(texts, words.PLAIN_WORDS)
    starts, ends, counts = words.word_bounds(data, offsets)
    n = len(starts)
    runs = find_runs(words.word_hashes(data, starts, ends), counts)
    stops = np.cumsum(counts)
    found: list[list[dict]] = [[] for _ in range(len(counts))]
    change = np.zeros(n + 1, np.int32)
    for start, length, period in runs:
        doc = int(np.searchsorted(stops, start, side="right"))
        found[doc].append({"start": start - int(stops[doc] - counts[doc]), "length": length, "period": period})
        change[start + period] += 1
        change[start + length] -= 1
    gone = np.cumsum(change[:n]) > 0
    collapsed = []
    for k, text in enumerate(texts.to_pylist()):
        parts = text.encode().split() if text else []
        if found[k]:
            own = gone[stops[k] - counts[k]:stops[k]].tolist()
            parts = [word for word, out in zip(parts, own) if not out]
        collapsed.append(b" ".join(parts))
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(counts, pa.int64()), pa.array(found, _RUNS),
         pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed_text"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, runs (start, length, period; by start, then period) and
    collapsed_text, the words joined by one space without those that a run holds after its first period.

    Words are what ASCII white space parts. A run is a stretch of at least LEAST_WORDS words and LEAST_PERIODS
    periods whose words one smallest period apart are equal, as long as it can be made. Every row is judged by
    itself, whatever its id: null and repeated ids stay as they are, null and empty texts have no words and no runs,
    an empty table gives no rows, and other columns are not read. Words are told apart by 64-bit hashes.
    """
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, count in tokens.stretches(batch.column(1), STRETCH_BYTES):
                yield _described(batch.slice(low, count))

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(describe, RUN_SCHEMA)
