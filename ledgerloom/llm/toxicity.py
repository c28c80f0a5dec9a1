"""Toxicity by a string-kernel support vector machine with Nystroem landmarks.

The kernel counts the common subsequences of LETTERS letters of two words, gaps allowed up to SPAN letters,
each gap letter weighing less by DECAY; so inserted and swapped-in characters lessen a match but don't end
it. Normalised, it is raised to POWER, which leaves words alike and parts the rest. Landmark words span the
feature space (Nystroem). A machine with squared hinge loss is trained there on labelled texts, each of which is judged by
one of its words: words that are frequent in toxic texts begin, with forms of them that have letters put in; in rounds
every text then gives the word with its greatest margin, toxic texts as an example and clean texts as a counter-example.

A word is scored once for a stretch of texts, against every landmark; only the landmarks that hold one of its
subsequences are looked up. A text is
judged by its worst word and by how many words are above STRONG, put on the scale of a probability by a logistic
fitted on labelled texts that the machine was not trained on.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import tokens, words

LETTERS = 3
SPAN = 6
DECAY = 0.7
POWER = 3
# Words above this margin are counted.
STRONG = 0.3
# Words are judged by pieces of this many letters, one beginning every other letter.
PIECE = 8
STEP = 2
# Labelled rows used at most; no more words than that begin the training, and each row adds one in a round.
MOST_ROWS = 20_000
# A word to begin with is more frequent among toxic texts by this many deviations.
DEVIATIONS = 5.0
LANDMARKS = 120
# Words looked at for landmarks, which are no more alike than SPACING.
MOST_SEEN = 1_000
SPACING = 0.6
ROUNDS = 3
COST = 10.0
# Clean texts count so many times.
CAUTION = 10.0
# What a word with letters put in weighs beside the word, and such letters.
DISGUISED = 0.3
_INSERTED = "xqzkjv"
THRESHOLD = 0.7

_CODES = 64
_LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
_SIGNS = re.compile(r"^[^\w]+|[^\w@$]+|[^\w]+$")
START = "^"


def _alphabet() -> np.ndarray:
    """A small code for each code point: letters, digits as the letters they stand for, the rest by remainder."""
    table = 27 + np.arange(0x110000, dtype=np.int64) % (_CODES - 27)
    for k in range(26):
        table[ord("a") + k] = k + 1
    for sign, letter in _LEET.items():
        table[ord(sign)] = table[ord(letter)]
    table[0] = 0
    return table.astype(np.uint8)


_ALPHABET = _alphabet()


def _paths(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of every subsequence of a word of this length, and their weights."""
    places = [(i, j, k) for i in range(length) for j in range(i + 1, length)
              for k in range(j + 1, min(length, i + SPAN))]
    if not places:
        return np.empty((0, 3), np.int64), np.empty(0, np.float32)
    chosen = np.array(places)
    return chosen, (DECAY ** (chosen[:, 2] - chosen[:, 0] + 1 - LETTERS)).astype(np.float32)


_PATHS = {length: _paths(length) for length in range(PIECE + 1)}


def pieces_of(word: str) -> list[str]:
    """The word in small letters behind a sign for its start, without other signs; a longer one as overlapping
    pieces that cover it."""
    word = START + _SIGNS.sub("", word).lower()
    if len(word) <= PIECE:
        return [word] if len(word) > LETTERS else []
    return [word[k:k + PIECE] for k in range(0, len(word) - PIECE + STEP, STEP)]


def subsequences(pieces: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(places in ``pieces``, subsequence codes, weights) for each length that occurs, in bounded blocks."""
    if not pieces:
        return
    letters = _ALPHABET[np.array(pieces, f"<U{PIECE}").view(np.uint32).reshape(len(pieces), PIECE)].astype(np.int32)
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    for length in np.unique(lengths).tolist():
        paths, weights = _PATHS[length]
        if not len(paths):
            continue
        own = np.flatnonzero(lengths == length)
        for low in range(0, len(own), 8_000):
            rows = own[low:low + 8_000]
            part = letters[rows]
            codes = (part[:, paths[:, 0]] * _CODES + part[:, paths[:, 1]]) * _CODES + part[:, paths[:, 2]]
            yield rows, codes, weights


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Lengths of the words' feature vectors: equal subsequences of a word add up first."""
    order = np.argsort(codes, axis=1, kind="stable")
    sorted_codes = np.take_along_axis(codes, order, axis=1)
    sorted_weights = weights[order]
    first = np.ones(codes.shape, bool)
    first[:, 1:] = sorted_codes[:, 1:] != sorted_codes[:, :-1]
    heads = np.flatnonzero(first.reshape(-1))
    sums = np.add.reduceat(sorted_weights.reshape(-1), heads)
    return np.sqrt(np.bincount(heads // codes.shape[1], weights=sums * sums, minlength=len(codes)))


@dataclass
class Model:
    """Landmarks as unit vectors over the subsequences ``codes``, a weight for each, and a bias.

    ``scale`` are the logistic's weights; ``empty`` marks the model that gives 0 to every text.
    """
    codes: np.ndarray
    units: np.ndarray
    weights: np.ndarray
    bias: float
    scale: tuple[float, ...] = (0.0, 0.0, 0.0)
    empty: bool = field(default=False)

    def __post_init__(self) -> None:
        # The landmarks that hold each subsequence, one after the other, and its weights there.
        code, self.landmark = np.nonzero(self.units.T)
        self.value = self.units.T[code, self.landmark].astype(np.float64)
        held = np.bincount(code, minlength=len(self.codes))
        self.held = np.concatenate([[0], held])
        self.first = np.concatenate([[0], np.cumsum(held) - held]).astype(np.int64)
        self.row = np.zeros(_CODES ** LETTERS, np.int32)
        self.row[self.codes] = np.arange(1, len(self.codes) + 1)

    def margins(self, pieces: list[str]) -> np.ndarray:
        """Margins of the pieces."""
        out = np.full(len(pieces), self.bias)
        many = len(self.weights)
        if not many:
            return out
        for rows, codes, weights in subsequences(pieces):
            norms = _norms(codes, weights)
            for low in range(0, len(rows), 1000):
                part = codes[low:low + 1000]
                place = self.row[part].reshape(-1)
                hit = np.flatnonzero(place)
                held = self.held[place[hit]]
                ends = np.cumsum(held)
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[place[hit]] - ends + held, held)
                alike = np.bincount(
                    np.repeat(hit // part.shape[1] * many, held) + self.landmark[at],
                    weights=np.repeat(weights[hit % part.shape[1]].astype(np.float64), held) * self.value[at],
                    minlength=len(part) * many).reshape(len(part), many)
                # Without any common subsequence the counts are whole numbers.
                alike = alike / norms[low:low + 1000, None]
                power = alike
                for _ in range(POWER - 1):
                    power = power * alike
                out[rows[low:low + 1000]] += power @ self.weights
        return out

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        if self.empty:
            return np.zeros(len(evidence))
        return 1 / (1 + np.exp(-np.clip(_design(evidence) @ np.asarray(self.scale), -500, 500)))


def _design(evidence: np.ndarray) -> np.ndarray:
    """Columns of the logistic: worst margin, number of words above STRONG on a log scale, one."""
    return np.stack([evidence[:, 0], np.log1p(evidence[:, 1]), np.ones(len(evidence))], axis=1)


# ---------------------------------------------------------------------------
# Words of stretches of texts


def _tokens(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, their places in the texts, text of each place). Runs of single letters also stand as one word."""
    data, offsets = words.buffers(texts, words.PLAIN_WORDS)
    starts, ends, counts = words.word_bounds(data, offsets)
    coded = words.word_array(data, starts, ends).dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    # Letters, not bytes; an accent that stands as a sign of its own belongs to its letter.
    letters = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)
    alone = letters == 1
    bytes_of = pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False)
    for k in np.flatnonzero((letters > 1) & (letters <= 4) & (bytes_of > letters)).tolist():
        alone[k] = all(map(unicodedata.combining, distinct[k][1:]))
    single = np.concatenate([[0], alone.astype(np.int8)[codes], [0]])
    edges = np.flatnonzero(np.diff(single)).reshape(-1, 2)
    extra, extra_owner = [], []
    for low, high in edges[edges[:, 1] - edges[:, 0] >= LETTERS].tolist():
        for doc in np.unique(owner[low:high]).tolist():
            own = codes[low:high][owner[low:high] == doc]
            if len(own) >= LETTERS:
                distinct.append("".join(distinct[c] for c in own.tolist()))
                extra.append(len(distinct) - 1)
                extra_owner.append(doc)
    return (distinct, np.concatenate([codes, np.array(extra, np.int64)]),
            np.concatenate([owner, np.array(extra_owner, np.int64)]))


def _best_pieces(model: Model, distinct: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(pieces, greatest margin of each word's pieces, place of that piece); the bias and -1 for words without pieces."""
    pieces: dict[str, int] = {}
    source: list[int] = []
    place: list[int] = []
    for k, word in enumerate(distinct):
        for piece in pieces_of(word):
            source.append(k)
            place.append(pieces.setdefault(piece, len(pieces)))
    by_word, at = np.full(len(distinct), -np.inf), np.full(len(distinct), -1, np.int64)
    words_of, pieces_at = np.asarray(source, np.int64), np.asarray(place, np.int64)
    margins = model.margins(list(pieces))[pieces_at]
    np.maximum.at(by_word, words_of, margins)
    best = margins == by_word[words_of]
    at[words_of[best]] = pieces_at[best]
    by_word[at < 0] = model.bias
    return list(pieces), by_word, at


def evidence_of(model: Model, texts: pa.Array) -> np.ndarray:
    """(greatest word margin, words above STRONG) of each text; the bias and 0 for texts without words."""
    distinct, codes, owner = _tokens(texts)
    _, by_word, _ = _best_pieces(model, distinct)
    margins = by_word[codes]
    out = np.stack([np.full(len(texts), model.bias), np.zeros(len(texts))], axis=1)
    np.maximum.at(out[:, 0], owner, margins)
    out[:, 1] = np.bincount(owner[margins > STRONG], minlength=len(texts))
    return out


# ---------------------------------------------------------------------------
# Training


def _word_counts(rows: DataFrame) -> DataFrame:
    """(word, n_toxic, n_clean): texts of either label that hold the word."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, n in tokens.stretches(batch.column(0)):
                part = batch.slice(low, n)
                distinct, codes, owner = _tokens(part.column(0))
                toxic = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                pairs = np.unique(np.stack([codes, owner], axis=1), axis=0) if len(codes) else np.empty((0, 2), np.int64)
                sums: dict[str, list[int]] = {}
                for label, counts in ((0, np.bincount(pairs[toxic[pairs[:, 1]], 0], minlength=len(distinct))),
                                      (1, np.bincount(pairs[~toxic[pairs[:, 1]], 0], minlength=len(distinct)))):
                    for k in np.flatnonzero(counts).tolist():
                        for piece in pieces_of(distinct[k]):
                            sums.setdefault(piece, [0, 0])[label] += int(counts[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sums), pa.string()), pa.array([v[0] for v in sums.values()], pa.int64()),
                     pa.array([v[1] for v in sums.values()], pa.int64())], ["word", "n_toxic", "n_clean"])

    return (rows.select("text", F.col("toxic").cast("boolean").alias("toxic"))
            .mapInArrow(count, "word string, n_toxic bigint, n_clean bigint")
            .groupBy("word").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean")))


def _kernel(left: list[str], right_codes: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The kernel of words with landmarks, whose unit vectors ``right`` stand over ``right_codes``."""
    out = np.zeros((len(left), right.shape[0]))
    by_code = np.concatenate([np.zeros((1, len(right)), np.float32), right.T])
    row = np.zeros(_CODES ** LETTERS, np.int32)
    row[right_codes] = np.arange(1, len(right_codes) + 1)
    for rows, codes, weights in subsequences(left):
        for low in range(0, len(rows), 500):
            part = codes[low:low + 500]
            out[rows[low:low + 500]] = (np.einsum("ntl,t->nl", by_code[row[part]], weights)
                                        / _norms(part, weights)[:, None])
    return out ** POWER


def _units(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, unit feature vectors over them) of the landmarks."""
    parts = [(row, c, weights) for rows, codes, weights in subsequences(landmarks) for row, c in zip(rows, codes)]
    every = np.unique(np.concatenate([c for _, c, _ in parts]))
    out = np.zeros((len(landmarks), len(every)), np.float32)
    for row, codes, weights in parts:
        np.add.at(out[row], np.searchsorted(every, codes), weights)
    return every, out / np.linalg.norm(out, axis=1, keepdims=True)


def variants_of(piece: str) -> list[str]:
    """The piece with one and with two letters put in, cut to its beginning and its end: forms that disguise it."""
    out: dict[str, None] = {}
    for low in range(2, len(piece)):
        one = piece[:low] + _INSERTED[low % len(_INSERTED)] + piece[low:]
        high = min(len(one) - 1, low + 3)
        for form in (one, one[:high] + _INSERTED[high % len(_INSERTED)] + one[high:]):
            out[form[:PIECE]] = out[form[-PIECE:]] = None
    return list(out)


def _apart(names: list[str], number: int) -> list[str]:
    """The first ``number`` words that are no more alike than SPACING to any word taken before."""
    if not names:
        return []
    _, units = _units(names)
    taken: list[int] = []
    for k in range(len(names)):
        if len(taken) == number:
            break
        if not taken or (units[taken] @ units[k]).max() ** POWER < SPACING:
            taken.append(k)
    return [names[k] for k in taken]


def fit_machine(counts: dict[str, tuple[float, float]], landmarks: list[str]) -> Model:
    """Squared-hinge machine over the landmarks' feature space, by Newton steps.

    ``counts`` has for each word what it weighs on the toxic and on the clean side.
    """
    codes, units = _units(sorted(landmarks))
    values, vectors = np.linalg.eigh((units @ units.T).astype(np.float64) ** POWER)
    keep = values > 1e-6 * values[-1]
    root = vectors[:, keep] / np.sqrt(values[keep])
    names = list(counts)
    x = _kernel(names, codes, units) @ root
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    toxic, clean = COST * np.array([counts[name] for name in names], np.float64).T
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])

    def loss(v: np.ndarray) -> float:
        m = x @ v
        return v @ ridge @ v + toxic @ np.maximum(0, 1 - m) ** 2 + clean @ np.maximum(0, 1 + m) ** 2

    best = loss(w)
    for _ in range(200):
        margin = x @ w
        up, down = np.where(margin < 1, toxic, 0.0), np.where(margin > -1, clean, 0.0)
        step = np.linalg.solve(ridge + x.T @ ((up + down)[:, None] * x), x.T @ (up - down)) - w
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > best:
            size /= 2
        now = loss(w + size * step)
        if now > best * (1 - 1e-6):
            break
        w, best = w + size * step, now
    return Model(codes, units, root @ w[:-1], float(w[-1]))


def _calibrated(model: Model, evidence: np.ndarray, toxic: np.ndarray) -> Model:
    """Fits the logistic by damped Newton steps, with targets drawn in a little and a small ridge."""
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = _design(evidence)
    w = np.zeros(x.shape[1])
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        hessian = x.T @ ((p * (1 - p))[:, None] * x) + 1e-3 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (target - p) - 1e-3 * w)
        step *= min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    model.scale = tuple(w.tolist())
    return model


def _evidence_rows(rows: DataFrame, model: Model) -> DataFrame:
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, n in tokens.stretches(batch.column(0)):
                part = batch.slice(low, n)
                evidence = evidence_of(model, part.column(0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(evidence[:, 0]), pa.array(evidence[:, 1]), part.column(1)], ["worst", "above", "toxic"])

    return rows.select("text", F.col("toxic").cast("boolean").alias("toxic")).mapInArrow(
        judge, "worst double, above double, toxic boolean")


def train(docs: DataFrame, labels: DataFrame, folder: str) -> Model:
    """A model from ``docs (doc_id, text)`` and ``labels (doc_id, toxic 0/1)``.

    MOST_ROWS labels are taken, in hash order of their ids. That bound on (doc_id, toxic) rows lets them meet the
    documents by broadcast, so no text moves but theirs. Two thirds train the machine, the rest the scale.
    Labels that are null, or whose document is missing or null, are left out; a document with several labels
    counts for each. Without both classes the model gives 0 to every text. ``folder`` is one that all
    executors share.
    """
    spark = docs.sparkSession
    drawn = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .select("doc_id", (F.col("toxic") == 1).alias("toxic"), F.xxhash64("doc_id").alias("turn"))
             .orderBy("turn", "doc_id", "toxic").limit(MOST_ROWS))
    chosen = docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    chosen.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "turn").write.parquet(f"{folder}/labelled")
    rows = spark.read.parquet(f"{folder}/labelled")
    # The turn's own low digits would follow the sample's order; its remainder by three does not.
    fit, scale = rows.where("pmod(turn, 3) < 2"), rows.where("pmod(turn, 3) = 2")
    n = {row.toxic: row.n for row in fit.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    nothing = Model(np.empty(0, np.int64), np.empty((0, 0), np.float32), np.empty(0), 0.0, empty=True)
    if len(n) < 2:
        return nothing
    _word_counts(fit).write.parquet(f"{folder}/words")
    counts = spark.read.parquet(f"{folder}/words")
    # Words to begin with: their share among toxic texts is above that among clean ones by DEVIATIONS.
    p1, p0 = F.col("n_toxic") / n[True], F.col("n_clean") / n[False]
    both = (F.col("n_toxic") + F.col("n_clean")) / (n[True] + n[False])
    spread = F.sqrt(both * (1 - both) * (1 / n[True] + 1 / n[False]))
    speaks = (F.col("n_toxic") >= 2) & (p1 - p0 > DEVIATIONS * spread) & (p1 > 5 * p0)

    def weights(word: str, n_toxic: int, n_clean: int) -> tuple[float, float]:
        share, other = n_toxic / n[True], CAUTION * (n_clean + 0.5) / n[False]
        texts = math.sqrt(n_toxic + n_clean)
        return texts * share / (share + other), (texts * other / (share + other) if n_clean else 0.0)

    # No more words than labelled rows, here and in each round, where a text gives one.
    seeds = {row.word: weights(*row) for row in counts.where(speaks).orderBy(F.desc((p1 - p0) / spread), "word")
             .limit(MOST_ROWS).collect()}
    silent = counts.where(~speaks & (F.col("n_clean") > 0))
    common = {row.word: weights(*row) for order in (F.desc("n_clean"), F.xxhash64("word"))
              for row in silent.orderBy(order, "word").limit(min(MOST_ROWS, n[False])).collect()}
    if not seeds or not common:
        return nothing
    # Every landmark is a word of the training set, drawn from both classes.
    half = LANDMARKS // 2
    landmarks = _apart(list(seeds)[:MOST_SEEN], half)
    landmarks += [w for w in _apart(sorted(common)[::max(1, len(common) // half)], half // 2) if w not in landmarks]
    disguised = {form: (DISGUISED * seeds[word][0], 0.0) for word in landmarks if word in seeds
                 for form in variants_of(word) if form not in seeds and form not in common}
    toxic, clean = seeds, common
    model = fit_machine(disguised | toxic | clean, landmarks)
    for _ in range(ROUNDS):
        # The word that a text is judged by: toxic texts need one of it above, clean texts have it below.
        found = (_witnesses(fit, model).groupBy("word").agg(F.count_if("toxic").alias("judged_toxic"),
                                                            F.count_if(~F.col("toxic")).alias("judged_clean"))
                 .join(counts, "word").select("word", "n_toxic", "n_clean", "judged_toxic", "judged_clean").collect())
        found.sort(key=lambda row: (-row.judged_clean, row.word))
        fresh = {}
        for row in found:
            lean = weights(row.word, row.n_toxic, row.n_clean)
            if row.judged_clean and row.word not in seeds:
                fresh[row.word] = lean
            elif row.judged_toxic > 1:
                toxic = toxic | {row.word: lean}
        landmarks += [word for word in _apart(list(fresh)[:MOST_SEEN], half // (2 * ROUNDS)) if word not in landmarks]
        clean = clean | fresh
        model = fit_machine({w: v for w, v in disguised.items() if w not in clean} | toxic | clean, landmarks)
    found = _evidence_rows(scale, model).collect()
    labels = np.array([row.toxic for row in found], bool)
    if not labels.any() or labels.all():
        return nothing
    return _calibrated(model, np.array([(row.worst, row.above) for row in found]), labels)


def _witnesses(rows: DataFrame, model: Model) -> DataFrame:
    """(word, toxic): the piece with the greatest margin of each text that has one, and the text's label."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, n in tokens.stretches(batch.column(0)):
                part = batch.slice(low, n)
                distinct, codes, owner = _tokens(part.column(0))
                pieces, by_word, at = _best_pieces(model, distinct)
                order = np.lexsort((codes, -by_word[codes], owner))
                order = order[at[codes[order]] >= 0]
                _, first = np.unique(owner[order], return_index=True)
                chosen = order[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pieces[k] for k in at[codes[chosen]].tolist()], pa.string()),
                     part.column(1).take(pa.array(owner[chosen]))], ["word", "toxic"])

    return rows.select("text", F.col("toxic").cast("boolean").alias("toxic")).mapInArrow(judge, "word string, toxic boolean")


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, score (0 to 1), predicted (1 from THRESHOLD on), and the columns ``keep``
    (those named like one of the first three as ``kept.name``).

    Null and empty texts score like a text without any word. Only the text enters the score.
    """
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, n in tokens.stretches(batch.column(1)):
                part = batch.slice(low, n)
                scores = model.probability(evidence_of(model, part.column(1)))
                # The text itself is not sent twice.
                kept = [part.column(1 if place is None else place) for place in places]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()),
                     pa.array((scores >= THRESHOLD).astype(np.int32), pa.int32()), *kept],
                    ["doc_id", "score", "predicted", *names])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                         *[F.col(c).alias(f"kept_{k}") for k, c in enumerate(keep) if c != text_col])
    others = iter(range(2, len(source.columns)))
    places = [None if c == text_col else next(others) for c in keep]
    names = [f"kept_{k}" for k in range(len(keep))]
    types = dict(source.dtypes) | {f"kept_{k}": "string" for k, c in enumerate(keep) if c == text_col}
    out = source.mapInArrow(judge, ", ".join(["doc_id bigint, score double, predicted int"]
                                             + [f"{name} {types[name]}" for name in names]))
    return out.select("doc_id", "score", "predicted", *[F.col(n).alias(f"kept.{c}" if c in (
        "doc_id", "score", "predicted") else c) for n, c in zip(names, keep)])
