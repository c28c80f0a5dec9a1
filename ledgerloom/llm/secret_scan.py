"""Secrets in texts, found through a trigram inverted index.

Each rule's regular expression gives a Boolean query: alternatives, each a set of trigrams that every match
must hold. The index has the postings of the queries' trigrams. Intersected postings give the candidates,
and only candidates are searched with the expression itself. A rule with an alternative that has no
trigram searches every text. Everything runs in DataFrame functions.
"""

from __future__ import annotations

import itertools
import re
import re._constants as ops
import re._parser as parser
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_ALTERNATIVES = 256
MOST_CLASS = 8
_KEY = ("doc_id", "text_hash")
# Trigrams for each number of a posting mask.
_MASK_BITS = 60

# Letters, digits and signs of assigned values; the base rules are fixed values.
_ASSIGN = (r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost and apart, whose ``group`` has at least ``least`` characters.

    The pattern must have no empty match and read the same in Java and Python.
    """
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


BASE_RULES = (
    Rule("assign", _ASSIGN, 2, 12, base=True),
    # Runs of one class: whatever starts a run ends with it, so the least length can stand in the expression.
    Rule("access", "AKIA[A-Z0-9]{14,}", 0, 18, base=True),
    Rule("hex", "[0-9a-f]{16,}", 0, 16, base=True),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("code_host", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\x00-\x20/:@]+:[^\x00-\x20/@]+@", 0, 1),
)


# ---------------------------------------------------------------------------
# Trigram queries


def _variants(node: Iterable) -> list[list[str]]:
    """What a parsed expression can read as lists of literal runs with gaps between them.

    Two neighbouring runs of a list are parted by something unknown; runs of different items join.
    """
    out = [[""]]
    for op, value in node:
        if op is ops.LITERAL:
            item = [[chr(value)]]
        elif op is ops.IN and 0 < len(chars := _class(value)) <= MOST_CLASS:
            item = [[c] for c in chars]
        elif op is ops.SUBPATTERN:
            item = _variants(value[-1])
        elif op is ops.BRANCH:
            item = [v for branch in value[1] for v in _variants(branch)]
        elif op in (ops.MAX_REPEAT, ops.MIN_REPEAT, ops.POSSESSIVE_REPEAT):
            low, high, inner = value
            if (low, high) == (0, 1):
                item = [[""]] + _variants(inner)
            elif low and low == high and low <= 8:
                item = _product([_variants(inner)] * low)
            else:
                # Whatever is repeated stands there once if it has to; then comes a gap.
                item = [v + [""] for v in _product([_variants(inner)] * min(low, 1))]
                item = [[""] + v for v in item] if low > 1 else item
        elif op is ops.AT:
            continue
        else:
            item = [["", ""]]
        out = _product([out, item])
        if len(out) > MOST_ALTERNATIVES:
            out = [["", ""]]
    return out


def _class(value: list) -> list[str]:
    """The characters of a small class; empty if it is negated or holds anything but characters and ranges."""
    chars: list[str] = []
    for op, x in value:
        if op is ops.LITERAL:
            chars.append(chr(x))
        elif op is ops.RANGE and x[1] - x[0] < MOST_CLASS:
            chars += map(chr, range(x[0], x[1] + 1))
        else:
            return []
    return chars


def _product(items: list[list[list[str]]]) -> list[list[str]]:
    out = [[""]]
    for item in items:
        out = [a[:-1] + [a[-1] + b[0]] + b[1:] for a, b in itertools.product(out, item)]
    return out


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternatives of trigrams, small letters, one of which any match must hold whole; empty: none can be told."""
    found = set()
    for variant in _variants(parser.parse(pattern)):
        grams = frozenset(run[k:k + 3].lower() for run in variant for k in range(len(run) - 2))
        if not grams:
            return []
        found.add(grams)
    # An alternative that holds another one whole adds nothing.
    return sorted((q for q in found if not any(other < q for other in found)), key=sorted)


def _trie(grams: Iterable[str]) -> str:
    """An expression for any of the trigrams that branches once per character."""
    tree: dict[str, dict[str, list[str]]] = {}
    for a, b, c in sorted(grams):
        tree.setdefault(a, {}).setdefault(b, []).append(c)

    def any_of(parts: list[str]) -> str:
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    return any_of([re.escape(a) + any_of([re.escape(b) + any_of([re.escape(c) for c in last])
                                          for b, last in second.items()]) for a, second in tree.items()])


# ---------------------------------------------------------------------------
# Index, candidates, verification


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once, however often they are read: nothing moves past a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, text_hash, text, has_text, kept): rows alike in id and text share a key and have the same result."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       text.alias("text"), F.col(text_col).isNotNull().alias("has_text"), F.struct(*keep).alias("kept") if keep else F.lit(None).alias("kept"))


def build_postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, doc_id, text_hash) of the given trigrams, once for each text that holds them."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"(?=({_trie(grams)}))"), 1))
    return docs.select(F.explode(found).alias("gram"), *_KEY)


def candidates(postings: DataFrame, queries: dict[str, list[frozenset[str]]], grams: list[str]) -> DataFrame:
    """(doc_id, text_hash, kinds) of the texts whose postings satisfy the query of at least one kind.

    A document's postings combine into bit masks before the shuffle, so one row of it crosses.
    """
    place = {gram: k for k, gram in enumerate(grams)}
    number = F.coalesce(*[F.when(F.col("gram") == gram, k) for gram, k in place.items()])
    n_masks = len(grams) // _MASK_BITS + 1
    bits = _once(postings, place=number).select(
        *_KEY, *[F.when(F.floor(F.col("place") / _MASK_BITS) == m,
                        F.expr(f"shiftleft(1L, int(place % {_MASK_BITS}))")).otherwise(F.lit(0).cast("bigint"))
                 .alias(f"m{m}") for m in range(n_masks)])
    masks = bits.groupBy(*_KEY).agg(*[F.bit_or(f"m{m}").alias(f"m{m}") for m in range(n_masks)])

    def holds(query: frozenset[str]) -> Column:
        wanted = [0] * n_masks
        for gram in query:
            wanted[place[gram] // _MASK_BITS] |= 1 << place[gram] % _MASK_BITS
        return reduce(lambda a, b: a & b, [F.col(f"m{m}").bitwiseAND(F.lit(w)) == F.lit(w)
                                           for m, w in enumerate(wanted) if w])

    kinds = F.array_compact(F.array(*[
        F.when(reduce(lambda a, b: a | b, map(holds, alternatives)), kind) for kind, alternatives in queries.items()]))
    return masks.select(*_KEY, kinds.alias("kinds")).where(F.size("kinds") > 0)


def spans_of(text: Column, rule: Rule, number: int) -> Column:
    """Spans (start, number, end) of the rule's matches, in code points.

    The pieces between matches and the matches themselves, laid end to end, are the text, which gives the places.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, 0)
    judged = F.regexp_extract_all(text, pattern, rule.group) if rule.group else matches
    found = F.arrays_zip(F.transform(F.split(text, rule.pattern, -1), lambda gap: F.length(gap)).alias("gap"),
                         F.transform(matches, lambda m: F.length(m)).alias("size"),
                         F.transform(judged, lambda m: F.length(m)).alias("judged"))
    none = F.array().cast("array<struct<start:int,number:int,end:int>>")
    state = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(s: Column, m: Column) -> Column:
        start = s["at"] + m["gap"]
        end = start + F.coalesce(m["size"], F.lit(0))
        span = F.array(F.struct(start.alias("start"), F.lit(number).alias("number"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.coalesce(m["judged"], F.lit(-1)) >= rule.least, F.concat(
            s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.when(text.rlike(rule.pattern), F.aggregate(found, state, step)["spans"]).otherwise(none)


def scan(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id",
         text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row (doc_id, text, spans) per document, with the columns ``keep`` in the struct ``kept``; spans are
    (start, kind, end, base) by start, then in the rules' order.

    Null texts have no spans and stay null. Rows with equal or null ids keep a row each. The postings are written below
    ``folder``, which all executors share.

    Texts meet their candidates in a shuffle join; a text comes into it only if it holds the rarest trigram of
    some alternative, by the counts of the index, since no candidate can lack that.
    """
    spark = docs.sparkSession
    source = keyed(docs, id_col, text_col, keep)
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = {kind: query for kind, query in queries.items() if query}
    numbers = {rule.kind: k for k, rule in enumerate(rules)}
    plain = [rule for rule in rules if not queries[rule.kind]]
    whole = source.select(*_KEY, "text", "has_text", "kept", F.concat(*[spans_of(F.col("text"), r, numbers[r.kind]) for r in plain],
                                                  F.array().cast("array<struct<start:int,number:int,end:int>>"))
                          .alias("spans"))
    if indexed:
        grams = sorted({gram for query in indexed.values() for q in query for gram in q})
        build_postings(source, grams).write.parquet(f"{folder}/postings")
        postings = spark.read.parquet(f"{folder}/postings")
        # One row for each trigram of the rules.
        count = {row.gram: row.n for row in postings.groupBy("gram").agg(F.count("*").alias("n")).collect()}
        rarest = sorted({min(sorted(q), key=lambda g: count.get(g, 0)) for query in indexed.values() for q in query})
        likely = source.where(reduce(lambda a, b: a | b, [F.contains(F.lower("text"), F.lit(g)) for g in rarest]))
        texts = candidates(postings, indexed, grams).alias("c").join(
            likely.drop("kept", "has_text").alias("l"), F.col("c.doc_id").eqNullSafe(F.col("l.doc_id"))
            & (F.col("c.text_hash") == F.col("l.text_hash"))).select("l.*", "kinds")
        found = texts.select(*_KEY, F.concat(*[
            F.when(F.array_contains("kinds", r.kind), spans_of(F.col("text"), r, numbers[r.kind])).otherwise(
                F.array().cast("array<struct<start:int,number:int,end:int>>"))
            for r in rules if r.kind in indexed]).alias("verified"))
        found = found.where(F.size("verified") > 0).groupBy(*_KEY).agg(F.first("verified").alias("verified"))
        # A null id has to meet itself: its text alone tells it apart.
        same = F.col("w.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("w.text_hash") == F.col("f.text_hash"))
        whole = whole.alias("w").join(found.alias("f"), same, "left").select("w.*", "verified").withColumn(
            "spans", F.concat("spans", F.coalesce("verified", F.expr("slice(spans, 1, 0)"))))
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    bases = F.array(*[F.lit(r.base) for r in rules])
    return whole.select("doc_id", F.when(F.col("has_text"), F.col("text")).alias("text"), "kept", F.transform(F.array_sort("spans"), lambda s: F.struct(
        s["start"].alias("start"), F.element_at(kinds, s["number"] + 1).alias("kind"), s["end"].alias("end"),
        F.element_at(bases, s["number"] + 1).alias("base"))).alias("spans"))


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span, or run of overlapping spans, replaced by the kind of its first one in brackets."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        between = F.substring(text, s["at"] + 1, F.greatest(span["start"] - s["at"], F.lit(0)))
        mark = F.when(span["start"] >= s["at"], F.concat(F.lit("["), span["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"),
                        F.concat(s["out"], between, mark).alias("out"))

    done = F.aggregate(spans, state, step)
    return F.when(F.size(spans) == 0, text).otherwise(
        F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
