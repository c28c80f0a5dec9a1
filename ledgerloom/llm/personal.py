"""Personal data: base patterns, and bootstrapped lexical patterns for identifiers that no base pattern knows.

One pass over the texts finds the base spans (e-mail, IP and phone numbers, payment cards) and candidates, words
with several digits outside of them. Each comes with its lexical patterns: the one and the two words before it and
behind it. A second pass counts how often those words stand anywhere at all. Patterns and instances (the texts of spans
and candidates) make a graph, which Spark scores in rounds: a pattern's confidence is the share of its words'
occurrences that stand at trusted instances, an instance's confidence follows from its confident patterns, and
base spans are trusted from the start. Candidates that come out trusted are spans as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import tokens, words
from ledgerloom.llm.components import written

KINDS = ("email", "ip", "card", "phone")
FOUND = "context"

# The base patterns. Possessive runs, and the look-behind where a match cannot begin inside a run of
# digits, find the same matches in linear time.
_DOMAIN = re.compile(rb"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_IP = re.compile(rb"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(rb"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS = (13, 19)
PHONE_DIGITS = (9, 15)
MOST_PART = 255

# A candidate has this many digits and characters.
LEAST_DIGITS = 4
LEAST_SIZE, MOST_SIZE = 6, 64
# A pattern counts with this many trusted instances and this share of its words' occurrences.
LEAST_SUPPORT = 3
LEAST_CONFIDENCE = 0.5
ROUNDS = 3
STRETCH_BYTES = 1 << 20
# Rows of a part of the tables in between.
PART_ROWS = 500_000
# Bits of the filter that leaves out words of no pattern before they are counted; it only saves work.
FILTER_BITS = 1 << 25
# Counts of words that a task holds before it adds them up and sends them on.
HELD_GRAMS = 1 << 19

# Bytes that bound the words of lexical patterns, besides white space: labels end in such, quotes surround values.
_BOUNDS = b"\"'()[]{}<>,;:=#|"
_LEXICAL = words.FOLDED_WORDS.copy()
_LEXICAL[list(_BOUNDS)] = 0x20

_SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_MENTIONS = "array<struct<kind:string,start:bigint,end:bigint,instance:string,patterns:array<struct<side:string,gram:bigint>>>>"
SCAN_SCHEMA = f"doc_id bigint, spans {_SPANS}, mentions {_MENTIONS}"


def passes_luhn(digits: bytes) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = (digit - 48) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(data: bytes) -> Iterator[tuple[int, int]]:
    """Each @ with what may stand before it, back to the last match or @, decides whether a match begins there."""
    low, at = 0, data.find(b"@")
    while at >= 0:
        local = len(data[low:at]) - len(data[low:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(data, at + 1) if local else None
        if domain:
            yield at - local, domain.end()
        low = domain.end() if domain else at + 1
        at = data.find(b"@", low)


def base_spans(data: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in bytes, by kind in the order of KINDS, then start."""
    out = [("email", a, b) for a, b in _emails(data)]
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(data)
            if all(len(part.lstrip(b"0")) <= 3 and int(part.lstrip(b"0") or b"0") <= MOST_PART for part in m.groups())]
    for kind, pattern, (least, most) in (("card", _CARD, CARD_DIGITS), ("phone", _PHONE, PHONE_DIGITS)):
        for m in pattern.finditer(data):
            digits = m.group().translate(None, b"+ ().-")
            if least <= len(digits) <= most and (kind != "card" or passes_luhn(digits)):
                out.append((kind, m.start(), m.end()))
    return out


@dataclass
class _Words:
    """The lexical words of some texts, and hashes of one and of two words that follow each other in a text."""
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    single: np.ndarray
    double: np.ndarray
    has_double: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array) -> _Words:
        data, offsets = words.buffers(texts, _LEXICAL)
        starts, ends, counts = words.word_bounds(data, offsets)
        single = words.word_hashes(data, starts, ends)
        pairs, places = words.window_hashes(single, counts, 2)
        double, has = np.zeros(len(single), np.uint64), np.zeros(len(single), bool)
        double[places], has[places] = pairs, True
        return cls(data, offsets, starts, ends, counts, single.view(np.int64), double.view(np.int64), has)


def _patterns(own: _Words, first: int, last: int, before: int, behind: int) -> list[dict]:
    """The lexical patterns of a mention: ``before`` counts the text's words that end at or before it begins,
    ``behind`` is the first word that begins at or after its end; words are numbered in ``first``..``last``."""
    out = []
    if before > first:
        out.append({"side": "before", "gram": int(own.single[before - 1])})
        if before - 1 > first:
            out.append({"side": "before", "gram": int(own.double[before - 2])})
    if behind < last:
        out.append({"side": "behind", "gram": int(own.single[behind])})
        if own.has_double[behind]:
            out.append({"side": "behind", "gram": int(own.double[behind])})
    return out


def _scanned(part: pa.RecordBatch) -> pa.RecordBatch:
    texts = part.column(1)
    raw, offsets = words.buffers(texts, np.arange(256, dtype=np.uint8))
    marked = (raw - np.uint8(0x30) < 10) | (raw == 0x40)
    sums = np.concatenate([[0], np.cumsum(marked)])
    marks = sums[offsets[1:]] - sums[offsets[:-1]]
    # Only texts with a digit or an @ can hold a span or a candidate.
    chosen = np.flatnonzero(marks > 0)
    own = _Words.of(texts.take(pa.array(chosen)))
    stops = np.cumsum(own.counts)
    spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
    mentions: list[list[dict]] = [[] for _ in range(part.num_rows)]
    for k, doc in enumerate(chosen.tolist()):
        view = raw[offsets[doc]:offsets[doc + 1]]
        data = view.tobytes()
        # Code points before each byte.
        points = np.concatenate([[0], np.cumsum((view & 0xC0) != 0x80)])
        base = base_spans(data)
        first, last = int(stops[k] - own.counts[k]), int(stops[k])
        starts, ends = (x[first:last] - own.offsets[k] for x in (own.starts, own.ends))
        digits = np.concatenate([[0], np.cumsum(view - np.uint8(0x30) < 10)])
        sizes = ends - starts
        able = np.flatnonzero((sizes >= LEAST_SIZE) & (digits[ends] - digits[starts] >= LEAST_DIGITS))
        covered = np.zeros(len(view) + 1, np.int32)
        for _, a, b in base:
            covered[a] += 1
            covered[b] -= 1
        covered = np.concatenate([[0], np.cumsum(np.cumsum(covered) > 0)])
        found = [(kind, a, b) for kind, a, b in base]
        for w in able.tolist():
            a, b = int(starts[w]), int(ends[w])
            trimmed = data[a:b].rstrip(b".!?-_%/\\*&~")
            b = a + len(trimmed)
            if LEAST_SIZE <= len(trimmed) <= MOST_SIZE and digits[b] - digits[a] >= LEAST_DIGITS and covered[b] == covered[a]:
                found.append((FOUND, a, b))
        for kind, a, b in found:
            start, end = int(points[a]), int(points[b])
            if kind != FOUND:
                spans[doc].append({"kind": kind, "start": start, "end": end})
            before = first + int(np.searchsorted(ends, a, side="right"))
            behind = first + int(np.searchsorted(starts, b, side="left"))
            mentions[doc].append({
                "kind": kind, "start": start, "end": end, "instance": data[a:b].lower().decode(),
                "patterns": _patterns(own, first, last, before, behind)})
    kinds = [pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])),
             pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()),
                                 ("patterns", pa.list_(pa.struct([("side", pa.string()), ("gram", pa.int64())])))]))]
    return pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kinds[0]), pa.array(mentions, kinds[1])],
                                      ["doc_id", "spans", "mentions"])


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def mentions_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with its base spans, and base spans and candidates with instance and patterns."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, count in tokens.stretches(batch.column(1), STRETCH_BYTES):
                yield _scanned(batch.slice(low, count))

    return _texts(docs, id_col, text_col).mapInArrow(scan, SCAN_SCHEMA)


def _filter_place(grams: np.ndarray, k: int) -> np.ndarray:
    """The first or the second of the two bits that each gram has in the filter."""
    return ((grams.view(np.uint64) >> np.uint64(32 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def _gram_filter(grams: DataFrame) -> np.ndarray:
    """The filter's bits, one byte for eight; each task sends its own bits as words, which Spark joins by OR.

    What reaches the driver is at most FILTER_BITS / 64 longs, however many grams there are.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            at = np.unique(np.concatenate([_filter_place(own, 0), _filter_place(own, 1)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 6, pa.int32()), pa.array(np.left_shift(np.int64(1), at & 63))], ["word", "bits"])

    rows = grams.select("gram").mapInArrow(place, "word int, bits bigint").groupBy("word").agg(
        F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint8)


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    found, at = np.unique(np.concatenate([grams for grams, _ in held]), return_inverse=True)
    n = np.zeros(len(found), np.int64)
    np.add.at(n, at, np.concatenate([counts for _, counts in held]))
    return pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], ["gram", "n"])


def gram_totals(docs: DataFrame, grams: DataFrame, text_col: str = "text") -> DataFrame:
    """(gram, total): how often each of ``grams`` (distinct) stands anywhere in ``docs``."""
    bits = _gram_filter(grams)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for low, rows in tokens.stretches(batch.column(0), STRETCH_BYTES):
                own = _Words.of(batch.column(0).slice(low, rows))
                every = np.concatenate([own.single, own.double[own.has_double]])
                for k in range(2):
                    at = _filter_place(every, k)
                    every = every[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
                held.append(np.unique(every, return_counts=True))
                size += len(held[-1][0])
                if size > HELD_GRAMS:
                    yield _added(held)
                    held, size = [], 0
        if held:
            yield _added(held)

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "gram bigint, n bigint")
    return counted.groupBy("gram").agg(F.sum("n").alias("total")).join(grams.select("gram"), "gram", "left_semi")


def _confident(edges: DataFrame, trust: DataFrame, confidence: float, support: int) -> DataFrame:
    """(side, gram, confidence) of the patterns with enough trusted instances and a high enough share."""
    scored = edges.join(trust, "instance").groupBy("side", "gram").agg(
        F.round(F.sum(F.col("n") * F.col("trust")) / F.first("total"), 9).alias("confidence"),
        F.count(F.when(F.col("trust") >= confidence, 1)).alias("support"))
    return scored.where((F.col("support") >= support) & (F.col("confidence") >= confidence)).select(
        "side", "gram", F.least("confidence", F.lit(1.0)).alias("confidence"))


def _trusted(edges: DataFrame, patterns: DataFrame, seeds: DataFrame) -> DataFrame:
    """(instance, trust): 1 for seeds, else the chance that not all of its confident patterns err."""
    doubt = F.sum(F.log1p(-F.least("confidence", F.lit(1 - 1e-9))))
    found = edges.join(patterns, ["side", "gram"]).groupBy("instance").agg(
        F.round(1 - F.exp(doubt), 9).alias("trust")).join(seeds, "instance", "left_anti")
    return found.unionByName(seeds)


def _parts(scanned: DataFrame) -> int:
    """How many parts the tables made of the mentions need: one for each core, or more where they have many rows.

    A mention has four patterns at most, and no table has more rows than there are. Left to the shuffle, small tables
    are cut into as many files as it has partitions, and every file in a local or mounted folder costs the executor
    several processes, which count with all of its memory while they start.
    """
    rows = 4 * (scanned.agg(F.sum(F.size("mentions"))).first()[0] or 0)
    return max(scanned.sparkSession.sparkContext.defaultParallelism, -(-rows // PART_ROWS))


def bootstrap(edges: DataFrame, seeds: DataFrame, folder: str, rounds: int = ROUNDS,
              confidence: float = LEAST_CONFIDENCE, support: int = LEAST_SUPPORT, parts: int | None = None) -> DataFrame:
    """(instance, trust) after some rounds over the graph ``edges (side, gram, instance, n, total)``.

    ``seeds (instance, trust)`` stay trusted. Every round is written below ``folder``, in ``parts`` files at most.
    """
    def kept(frame: DataFrame, name: str) -> DataFrame:
        return written(frame.coalesce(parts) if parts else frame, folder, name)

    trust = seeds
    for k in range(rounds):
        patterns = kept(_confident(edges, trust, confidence, support), f"patterns{k}")
        trust = kept(_trusted(edges, patterns, seeds), f"trust{k}")
    return trust


def find_personal(docs: DataFrame, folder: str, rounds: int = ROUNDS, confidence: float = LEAST_CONFIDENCE,
                  support: int = LEAST_SUPPORT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id and spans (kind, start, end in code points, end exclusive), base spans by kind
    in the order of KINDS and then start, behind them those of kind ``context`` by start.

    Base spans are leftmost and do not overlap within their kind; a match that fails its check is dropped. Candidates
    never overlap base spans. Null and empty texts have no spans, rows with equal or null ids stay apart, an empty
    table gives no rows and other columns are not read; words beyond 64 characters are no candidates. Patterns and
    words are told apart by 64-bit hashes. Tables in between are written below ``folder``.
    """
    scanned = written(mentions_of(docs, id_col, text_col).withColumn("row", F.expr("uuid()")), folder, "scan")
    parts = _parts(scanned)
    every = scanned.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    edges = every.select((F.col("kind") != FOUND).alias("seed"), "instance", F.explode("patterns").alias("p")).groupBy(
        "p.side", "p.gram", "instance").agg(F.count("*").alias("n"))
    # A pattern with fewer instances than it needs can never count, so its words are not looked up.
    edges = written(edges.coalesce(parts), folder, "graph")
    wide = edges.groupBy("side", "gram").agg(F.count("*").alias("instances")).where(F.col("instances") >= support)
    grams = written(wide.select("side", "gram").coalesce(parts), folder, "grams")
    totals = written(gram_totals(docs, grams.select("gram").distinct(), text_col).coalesce(parts), folder, "totals")
    edges = written(edges.join(grams, ["side", "gram"], "left_semi").join(totals, "gram").coalesce(parts), folder, "edges")
    seeds = written(every.where(F.col("kind") != FOUND).select("instance").distinct().withColumn(
        "trust", F.lit(1.0)).coalesce(parts), folder, "seeds")
    trust = bootstrap(edges, seeds, folder, rounds, confidence, support, parts)
    trusted = trust.where(F.col("trust") >= confidence).select("instance")
    span = F.struct(F.lit(FOUND).alias("kind"), "start", "end")
    found = every.where(F.col("kind") == FOUND).join(trusted, "instance", "left_semi").groupBy("row").agg(
        F.array_sort(F.collect_list(span)).alias("found"))
    # Not in more parts than the texts were read in.
    return scanned.select("row", "doc_id", "spans").join(found, "row", "left").select(
        "doc_id", F.concat("spans", F.coalesce("found", F.array().cast(_SPANS))).alias("spans")).coalesce(
        max(parts, len(scanned.inputFiles())))


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
