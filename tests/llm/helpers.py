"""Small frames with the awkward rows every operator has to take."""

from __future__ import annotations

import re

DOCS = "doc_id bigint, text string, kept boolean, n_words int, spans string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def small(text: str) -> str:
    return "".join(c.lower() if c < "\x80" else c for c in text)


def docs_of(spark, rows):
    """(doc_id, text) rows with columns whose names clash with those of results."""
    return spark.createDataFrame([(a, b, True, 7, "x") for a, b in rows], DOCS)


AWKWARD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (None, "a null id stands here"), (5, "one"), (5, "one")]


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
