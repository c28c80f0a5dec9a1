"""Packing of documents into sequences by order-preserving dynamic programming.

The documents of a partition, in their order, are one run of tokens. Cuts are chosen among document ends,
sentence ends and, in long stretches without either, every HARD_STEP tokens. The cost of a window is its
padding, the penalty of its cut, and a small price for one more sequence. A window may hold any length up
to the sequence length, which makes the best predecessor a sliding-window minimum, kept in a monotone queue;
windows whose length is a power of two need no padding and are tried besides.

A task solves its run in segments of about SEGMENT_TOKENS and carries the last windows of a segment over to
the next one, so its memory doesn't grow with its partition. Nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import tokens

SENTENCE_PENALTY = 8
HARD_PENALTY = 64
SEQUENCE_PRICE = 16
HARD_STEP = 512
SEGMENT_TOKENS = 4 << 20
CARRIED_WINDOWS = 4
# Text that is encoded at a time: the longer, the more of its words repeat.
STRETCH_BYTES = 16 << 20
SHORT_POWERS = (256, 512, 1024, 2048)

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")


def padding(length: int, size: int) -> int:
    return 0 if length & (length - 1) == 0 else size - length


def cut_positions(doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions where a window may end, penalty of each), both behind position 0 and up to ``total``."""
    kind = np.zeros(total + 1, np.int8)
    kind[sentence_ends[sentence_ends <= total]] = 1
    kind[doc_ends[doc_ends <= total]] = 2
    kind[[0, total]] = 2
    places = np.flatnonzero(kind)
    for k in np.flatnonzero(np.diff(places) > HARD_STEP).tolist():
        kind[places[k] + HARD_STEP:places[k + 1]:HARD_STEP] = 3
    every = np.flatnonzero(kind)[1:]
    return every, np.array([0, SENTENCE_PENALTY, 0, HARD_PENALTY], np.int64)[kind[every]]


def best_cuts(places: np.ndarray, penalties: np.ndarray, size: int) -> list[int]:
    """Ends of the windows of least cost that cover 0 to ``places[-1]``."""
    position = [0, *places.tolist()]
    price = [0, *(penalties + SEQUENCE_PRICE).tolist()]
    n = len(position)
    whole = np.concatenate([[0], places])
    short: dict[int, list[int]] = {}
    for power in SHORT_POWERS:
        if power < size:
            found = np.searchsorted(whole, whole - power)
            for j in np.flatnonzero(whole[np.minimum(found, n - 1)] == whole - power).tolist():
                short.setdefault(j, []).append(int(found[j]))
    cost = [0] * n
    came = [0] * n
    queue = deque([0])
    gain = [0] * n  # cost + position: what a predecessor adds, apart from the end of the window
    for j in range(1, n):
        here = position[j]
        low = here - size
        while position[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        best = gain[i] - low
        for k in short.get(j, ()):
            if cost[k] < best:
                best, i = cost[k], k
        best += price[j]
        cost[j] = best
        came[j] = i
        value = best + here
        gain[j] = value
        while queue and gain[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    out = []
    j = n - 1
    while j:
        out.append(position[j])
        j = came[j]
    return out[::-1]


def split_last(start: int, end: int, size: int) -> list[int]:
    """Ends of the parts of the last window: powers of two where their cuts cost less than its padding."""
    length = end - start
    parts = [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]
    if (len(parts) - 1) * (HARD_PENALTY + SEQUENCE_PRICE) >= padding(length, size):
        return [end]
    return (start + np.cumsum(parts)).tolist()


class _Run:
    """The documents of one partition, packed segment by segment."""

    def __init__(self, size: int, partition: int) -> None:
        self.size = size
        self.sequence = partition << 40
        self.ids = np.empty(0, np.int32)
        self.sentences = np.empty(0, np.int64)
        # One row per document that is not yet packed whole: id, its ids before this segment, its length.
        self.docs: list[tuple[int | None, int, int]] = []

    def add(self, doc_ids: list[int | None], ids: np.ndarray, lengths: np.ndarray, sentences: np.ndarray) -> None:
        self.sentences = np.concatenate([self.sentences, sentences + len(self.ids)])
        self.ids = np.concatenate([self.ids, ids])
        self.docs += [(doc, 0, n) for doc, n in zip(doc_ids, lengths.tolist())]

    def pack(self, last: bool) -> pa.RecordBatch | None:
        """Packs the segment; its last windows wait for what follows unless it is the last segment."""
        total = len(self.ids)
        if not total:
            return None
        doc_ends = np.cumsum([length - done for _, done, length in self.docs])
        cuts = best_cuts(*cut_positions(doc_ends, self.sentences, total), self.size)
        if last:
            cuts[-1:] = split_last(cuts[-2] if len(cuts) > 1 else 0, cuts[-1], self.size)
        elif len(cuts) > CARRIED_WINDOWS:
            cuts = cuts[:-CARRIED_WINDOWS]
        else:
            return None
        rows: list[tuple] = []
        low = at = 0
        doc, done, length = self.docs[0]
        raw = self.ids.astype("<u4")
        for cut in cuts:
            begin = low
            while low < cut:
                if done == length:
                    at += 1
                    doc, done, length = self.docs[at]
                take = min(cut - low, length - done)
                rows.append((doc, done, take, zlib.crc32(raw[low:low + take].tobytes()), length, self.sequence,
                             low - begin))
                low += take
                done += take
            self.sequence += 1
        self.docs = ([] if done == length else [(doc, done, length)]) + self.docs[at + 1:]
        self.ids = self.ids[low:]
        self.sentences = self.sentences[self.sentences > low] - low
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(column, pa.int64()) for column in zip(*rows)], names)


def pack_documents(docs: DataFrame, tokenizer_path: str, last_id: int, size: int = 4096, id_col: str = "doc_id",
                   text_col: str = "text", segment_tokens: int = SEGMENT_TOKENS,
                   stretch_bytes: int = STRETCH_BYTES) -> DataFrame:
    """One row (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece of a document.

    Documents keep the order they have in their partition. A null or empty text is its closing id alone;
    a document longer than a sequence is cut; rows with equal or null ids are documents of their own.
    An empty table has no pieces. Other columns are not read.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        json = file.read()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = _Run(size, TaskContext.get().partitionId())
        for batch in batches:
            for low, count in tokens.stretches(batch.column(1), stretch_bytes):
                part = batch.slice(low, count)
                run.add(part.column(0).to_pylist(), *tokens.encode_texts(json, part.column(1), last_id))
                if len(run.ids) >= segment_tokens and (rows := run.pack(last=False)):
                    yield rows
        if rows := run.pack(last=True):
            yield rows

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
                       ).mapInArrow(pack, SCHEMA)
