"""Token ids of whole texts, by way of their distinct words.

The tokenizer drops white space and never joins what white space parts, so the ids of a text are those of
its words one after the other. Each distinct word of a stretch of texts is encoded once; letters followed by
punctuation are encoded as the letters and the punctuation, which the tokenizer parts as well.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRETCH_BYTES = 8 << 20
SEPARATOR = "<|endoftext|>"

_loaded: dict[int, object] = {}


def _tokenizer(json: str):
    """The tokenizer of this JSON, loaded once in each worker; it must not start threads of its own there."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    key = hash(json)
    if key not in _loaded:
        _loaded[key] = Tokenizer.from_str(json)
    return _loaded[key]


def stretches(texts: pa.Array, most_bytes: int = STRETCH_BYTES):
    """(first, count) of consecutive rows with about ``most_bytes`` of text each; a longer text stands alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    low = 0
    while low < len(sizes):
        base = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield low, high - low
        low = high


# Punctuation that the tokenizer keeps together and apart from letters; an apostrophe can join letters.
_TAIL = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")


Flat = tuple[np.ndarray, np.ndarray]


def _joined(parts: list[Flat]) -> Flat:
    return (np.concatenate([ids for ids, _ in parts] or [np.empty(0, np.int32)]),
            np.concatenate([sizes for _, sizes in parts] or [np.empty(0, np.int64)]))


def _parted_ids(tokenizer, words: list[str]) -> Flat:
    """(ids, ids per word) of words encoded together with a special token between them."""
    separator = tokenizer.token_to_id(SEPARATOR)
    out: list[Flat] = []
    for low in range(0, len(words), 4096):
        part = words[low:low + 4096]
        if any("<|" in word for word in part):
            own = [np.array(tokenizer.encode(word, add_special_tokens=False).ids, np.int32) for word in part]
            out.append((np.concatenate(own), np.array([len(x) for x in own], np.int64)))
            continue
        joined = SEPARATOR.join(part) + SEPARATOR
        ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(ids == separator)
        out.append((ids[ids != separator], np.diff(ends, prepend=-1) - 1))
    return _joined(out)


def _letter_ids(tokenizer, words: list[str], closes: np.ndarray) -> Flat:
    """The same of words of letters only: each ends with its first id that closes a word."""
    out: list[Flat] = []
    for low in range(0, len(words), 4096):
        part = words[low:low + 4096]
        ids = np.array(tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(closes[ids])
        out.append((ids, np.diff(ends, prepend=-1)) if len(ends) == len(part) else _parted_ids(tokenizer, part))
    return _joined(out)


_closing: dict[int, np.ndarray] = {}


def _closes(tokenizer) -> np.ndarray:
    """Whether an id closes a word, by id."""
    if id(tokenizer) not in _closing:
        vocabulary = tokenizer.get_vocab()
        flags = np.zeros(max(vocabulary.values()) + 1, bool)
        flags[[k for name, k in vocabulary.items() if name.endswith("</w>")]] = True
        _closing[id(tokenizer)] = flags
    return _closing[id(tokenizer)]


def _word_ids(tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, number of ids per word)."""
    letters: dict[str, int] = {}
    tails: dict[str, int] = {"": 0}
    others: dict[str, int] = {}
    first, second = [], []
    for word in words:
        core = word if word.isalpha() else word.rstrip(_TAIL)
        if core.isalpha() and (core.isascii() or core.lower().isalpha()):
            first.append(letters.setdefault(core, len(letters)))
            second.append(0 if core is word else tails.setdefault(word[len(core):], len(tails)))
        else:
            first.append(-1 - others.setdefault(word, len(others)))
            second.append(0)
    flat, sizes = _joined([_letter_ids(tokenizer, list(letters), _closes(tokenizer)),
                           _parted_ids(tokenizer, list(others)), _parted_ids(tokenizer, list(tails))])
    # Every word is one part and a tail; the parts lie one after the other, and each word gathers its own.
    head = np.asarray(first, np.int64)
    head = np.where(head < 0, len(letters) - 1 - head, head)
    chosen = np.stack([head, len(letters) + len(others) + np.asarray(second, np.int64)], axis=1).reshape(-1)
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[chosen]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    ids = flat[np.repeat(starts[chosen] - (ends - lengths), lengths) + np.arange(total)]
    return ids, lengths.reshape(-1, 2).sum(axis=1)


def encode_texts(json: str, texts: pa.Array, last_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, each followed by ``last_id``; ids per text; sentence ends).

    Sentence ends are the positions behind a word that ends in a full stop, exclamation or question mark.
    Null texts are empty.
    """
    tokenizer = _tokenizer(json)
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    words = coded.dictionary.to_pylist()
    ids, counts = _word_ids(tokenizer, words)
    stops = np.array([word.endswith((".", "!", "?")) for word in words] + [False])
    # The closing id is one more word, set in behind each text's words.
    codes = np.insert(coded.indices.to_numpy(zero_copy_only=False), np.cumsum(per_text), len(words))
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    ids = np.append(ids, np.int32(last_id))
    counts = np.append(counts, 1).astype(np.int64)
    lengths = counts[codes]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    out = ids[np.repeat(starts[codes] - (ends - lengths), lengths) + np.arange(total)]
    text_ends = np.cumsum(per_text + 1) - 1
    token_ends = ends[text_ends] if len(ends) else np.empty(0, np.int64)
    return out, np.diff(token_ends, prepend=0), ends[stops[codes]]
