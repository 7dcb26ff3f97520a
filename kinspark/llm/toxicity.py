"""Toxicity by a subsequence string kernel and a support vector machine.

A token is described by all its subsequences of LENGTH symbols, also with gaps: each
occurrence weighs DECAY^(letters skipped) within a span of SPAN symbols, scaled by the
token's length (up to NORMED symbols). The kernel of two tokens is the product of their descriptions, so that an insult with
letters inserted or left out stays near itself. Letters parted by punctuation or blanks
("i.d.i.o.t", "i d i o t") are read as one token. Landmark tokens span the Nyström
approximation of the kernel; a sentence is the sum of its distinct tokens' Nyström features, and
a linear support vector machine over them is trained on labelled sentences: those of
clean documents, and of each toxic document the one that is most toxic under the model
so far, with up to TOP - 1 others that it calls toxic. A document is judged by the margins of its TOP most toxic sentences and their
number, by a logistic curve fitted on the training documents.

As sums and machine are linear, a token's part of the margin is a look-up of its
subsequences in one table of SYMBOLS^LENGTH numbers, the same at every size of corpus.
Subsequences are read off by their offsets for all tokens of a run at a time, CHUNK
symbols in a go, so a token of any length costs time by its length and no more memory.
Letters beyond Latin are hashed to symbols, so words of other scripts differ as well.

Defined results: null texts and texts without a token have the margins of empty
sentences; repeated rows score alike; with no labels of both kinds every score is 0;
added columns (score, predicted) replace columns of those names. A sentence ends at
a full stop, `!` or `?` (also in their wide forms) before a blank, at a line's end, and after MOST_TOKENS tokens; a run of
letters that stand alone is never parted.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import held_out, labelled_sample

SYMBOLS = 32
LENGTH = 4
DECAY = 0.6
SPAN = 7
MOST_TOKENS = 40
#: Symbols up to which a token's description is scaled by its length; a longer one counts like several.
NORMED = 24
#: Sentences of a document that its score goes by.
TOP = 3
#: Symbols that are looked up at a time.
CHUNK = 1 << 17
#: Tokens that are laid out at a time.
RUN = 5000
#: Rows of Nyström features or landmark descriptions that are added up at a time.
ADDED = 4000
#: Bound on the labelled documents of each class that the model is fitted on.
PER_CLASS = 1200
LANDMARKS = 256
PENALTY = 1e-4
#: What a mark of a toxic document must weigh for a second sentence to count at first: one of the first fifty does.
LEAST_MARK = 0.02
#: Bound on the tokens whose scores a worker remembers.
REMEMBERED = 400_000

#: Characters written for letters (fixed values).
LOOKS_LIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
EDGE = SYMBOLS - 1
_LOOKS = str.maketrans(LOOKS_LIKE)
_AROUND = ".,;:!?\"'()[]{}*_-%&#|<>~`…«»„“”"


def letters(token: str) -> str:
    """The token's letters and digits; beside letters, what looks like one is read as one."""
    inner = token.strip(_AROUND)
    if not inner.isalpha():
        if any(map(str.isalpha, inner)):
            inner = inner.translate(_LOOKS)
        inner = "".join(filter(str.isalnum, inner))
    return inner


def _symbol_table() -> np.ndarray:
    """A symbol for each code point up to U+024F: Latin letters without their accents from 0, others above."""
    out = 26 + np.arange(0x250) % (SYMBOLS - 27)
    for o in range(0x250):
        base = unicodedata.normalize("NFKD", chr(o)).lower()[:1]
        if "a" <= base <= "z":
            out[o] = ord(base) - 97
    return out


_SYMBOL = _symbol_table()
#: Offsets of a subsequence from its first symbol.
_OFFSETS = np.array(list(combinations(range(1, SPAN), LENGTH - 1)))
_WEIGHTS = DECAY ** (_OFFSETS[:, -1] - (LENGTH - 1.0))


def _symbols(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all tokens, each between edges, and where each token begins and the last ends."""
    size = np.array([len(t) + 2 for t in tokens], np.int64)
    starts = np.r_[0, np.cumsum(size)]
    codes = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
    hashed = (codes.astype(np.uint64) * np.uint64(0x9E3779B1) >> np.uint64(12)) % np.uint64(EDGE)
    out = np.full(starts[-1], EDGE, np.int64)
    inner = np.ones(len(out), bool)
    inner[starts[:-1]] = inner[starts[1:] - 1] = False
    out[inner] = np.where(codes < 0x250, _SYMBOL[np.minimum(codes, 0x24F)], hashed)
    return out, starts


def _grams(tokens: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of places in the tokens' symbols: the token of each, the index of each subsequence that begins there
    (0 in places where it would leave the token), and its weight, 0 there."""
    for at in range(0, len(tokens), RUN):
        for owner, index, weight in _some_grams(tokens[at : at + RUN]):
            yield owner + at, index, weight


def _some_grams(tokens: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    symbols, starts = _symbols(tokens)
    size = np.diff(starts)
    # the norm of what a token of so many symbols has
    count = np.maximum(0, np.minimum(size, NORMED)[:, None] - _OFFSETS[:, -1])
    norm = np.sqrt(np.maximum(1e-9, count @ _WEIGHTS**2))
    owner = np.repeat(np.arange(len(tokens)), size)
    left = np.repeat(starts[1:], size) - np.arange(len(symbols))  # symbols from here to the token's end
    padded = np.r_[symbols, np.zeros(SPAN, np.int64)]
    step = max(1, CHUNK // len(_OFFSETS))
    for at in range(0, len(symbols), step):
        here = np.arange(at, min(at + step, len(symbols)))
        index = padded[here][:, None]
        for k in range(LENGTH - 1):
            index = index * SYMBOLS + padded[here[:, None] + _OFFSETS[:, k]]
        weight = np.where(left[here][:, None] > _OFFSETS[:, -1], _WEIGHTS / norm[owner[here]][:, None], 0)
        yield owner[here], np.where(weight > 0, index, 0), weight.astype(np.float32)


class Landmarks:
    """Landmark tokens, described over the subsequences that any of them has."""

    def __init__(self, tokens: list[str]):
        parts = list(_grams(tokens))
        self.used = np.unique(np.concatenate([i[w > 0] for _, i, w in parts]))
        self.described = np.zeros((len(self.used) + 1, len(tokens)), np.float32)
        for owner, index, weight in parts:
            rows, cols = np.nonzero(weight)
            np.add.at(self.described, (np.searchsorted(self.used, index[rows, cols]) + 1, owner[rows]), weight[rows, cols])
        self.place = np.zeros(SYMBOLS**LENGTH, np.int32)
        self.place[self.used] = np.arange(1, len(self.used) + 1)

    def kernel(self, tokens: list[str]) -> np.ndarray:
        """Kernel values of tokens with the landmarks."""
        out = np.zeros((len(tokens), self.described.shape[1]), np.float32)
        for owner, index, weight in _grams(tokens):
            at = np.where(weight > 0, self.place[index], 0)
            rows, cols = np.nonzero(at)
            for lo in range(0, len(rows), ADDED):
                r, c = rows[lo : lo + ADDED], cols[lo : lo + ADDED]
                own = owner[r]
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                part = self.described[at[r, c]]
                part *= weight[r, c, None]
                out[own[first]] += np.add.reduceat(part, first, axis=0)
        return out

    def table(self, weights: np.ndarray) -> np.ndarray:
        """What each subsequence adds, where landmark j has the weight weights[j]."""
        out = np.zeros(SYMBOLS**LENGTH, np.float32)
        out[self.used] = self.described[1:] @ weights
        return out


def tokenise(text: str) -> list[str]:
    """Lower-cased words; a line's end is a token of its own."""
    return text.lower().replace("\n", " \n ").replace(" \n ", " \x00 ").split()


def ends_sentence(word: str, token: str) -> bool:
    return word == "\x00" or (word[-1] in ".!?。！？" and len(token) != 1)


def sentences(words: list[str]) -> list[list[str]]:
    """The distinct tokens of each sentence; three or more letters that stand alone in a row are one."""
    units: list[tuple[str, bool]] = []
    lone: list[str] = []

    def flush():
        units.extend((t, False) for t in (["".join(lone)] if len(lone) > 2 else lone))
        lone.clear()

    for w in words:
        t = letters(w)
        if len(t) == 1:
            lone.append(t)
        else:
            flush()
            units.append((t, ends_sentence(w, t)))
    flush()
    out: list[dict[str, None]] = [{}]
    read = 0
    for t, end in units:
        read += 1
        if t:
            out[-1][t] = None
        if end or read == MOST_TOKENS:
            out.append({})
            read = 0
    return [list(s) for s in out if s]


@dataclass
class Model:
    #: A token's part of the margin for each subsequence.
    table: np.ndarray
    bias: float
    #: Of the logistic curve over what describe() gives, its weights and its shift.
    slopes: np.ndarray
    shift: float
    #: Words met, by number; of each its token's number, whether it ends a sentence and stands alone; tokens met and their scores.
    seen: dict = field(default_factory=dict)
    facts: np.ndarray = field(default_factory=lambda: np.zeros((0, 3), np.int32))
    tokens: dict = field(default_factory=dict)
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))

    def forget(self) -> None:
        self.seen, self.tokens, self.facts, self.known = {}, {}, np.zeros((0, 3), np.int32), np.zeros(0, np.float32)

    def __getstate__(self):
        return self.__dict__ | {"seen": {}, "tokens": {}, "facts": np.zeros((0, 3), np.int32), "known": np.zeros(0, np.float32)}

    def token_scores(self, tokens: list[str]) -> np.ndarray:
        out = np.zeros(len(tokens))
        for owner, index, weight in _grams(tokens):
            np.add.at(out, owner, (self.table[index] * weight).sum(axis=1))
        return out.astype(np.float32)

    def plain_sums(self, text: str) -> list[float]:
        """A number for each sentence."""
        return [float(self.token_scores(s).sum()) for s in sentences(tokenise(text))]

    def _learn(self, words: list[str]) -> None:
        if len(self.seen) > REMEMBERED:
            self.forget()
        if new := list(set(words).difference(self.seen)):
            tokens = [letters(w) for w in new]
            if fresh := [t for t in dict.fromkeys(tokens) if t not in self.tokens]:
                self.known = np.concatenate([self.known, self.token_scores(fresh)])
                self.tokens.update(zip(fresh, range(len(self.tokens), len(self.known)), strict=True))
            self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new)), strict=True))
            facts = [[self.tokens[t], ends_sentence(w, t), len(t) == 1] for w, t in zip(new, tokens, strict=True)]
            self.facts = np.concatenate([self.facts, np.array(facts, np.int32)])

    def describe(self, texts: list[str]) -> np.ndarray:
        """Of each text the margins of its TOP sentences, in order (those of empty ones where there are fewer), and the
        logarithm of their number."""
        out, run, size = [np.zeros((0, TOP + 1))], [], 0
        for t in [*texts, None]:
            if run and (t is None or size + len(t) > 1 << 19):
                out.append(self._run(run))
                run, size = [], 0
            if t is not None:
                run.append(t)
                size += len(t)
        return np.concatenate(out)

    def _run(self, texts: list[str]) -> np.ndarray:
        split = [tokenise(t) for t in texts]
        words = [w for s in split for w in s]
        self._learn(words)
        ids = np.fromiter(map(self.seen.__getitem__, words), np.int64, len(words))
        count = np.array([len(s) for s in split])
        out = np.zeros((len(texts), TOP + 1))
        if not len(ids):
            out[:, :TOP] = self.bias
            return out
        token, ends, lone = self.facts[ids].T
        owner = np.repeat(np.arange(len(texts)), count)
        new = np.r_[True, (ends[:-1] > 0) | (owner[1:] != owner[:-1])]
        begin = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
        new |= (np.arange(len(ids)) - begin) % MOST_TOKENS == 0
        unit = np.cumsum(new) - 1
        _, first = np.unique(unit * len(self.known) + token, return_index=True)
        sums = np.bincount(unit[first], self.known[token[first]])
        home = owner[new]
        full = np.bincount(unit, token != self.tokens.get("", -1)) > 0  # sentences with a token
        sums, home = sums[full], home[full]
        if len(ids) > 2:
            apart = np.unique(owner[2:][(lone[2:] * lone[1:-1] * lone[:-2] > 0) & (owner[2:] == owner[:-2])])
            keep = ~np.isin(home, apart)
            own = [(i, x) for i in apart for x in self.plain_sums(texts[i])]
            sums, home = np.r_[sums[keep], [x for _, x in own]], np.r_[home[keep], np.array([i for i, _ in own], np.int64)]
        order = np.lexsort((-sums, home))
        sums, home = sums[order], home[order]
        number = np.bincount(home, minlength=len(texts))
        rank = np.arange(len(home)) - (np.cumsum(number) - number)[home]
        out[home[rank < TOP], rank[rank < TOP]] = sums[rank < TOP]
        out[:, :TOP] += self.bias
        out[:, TOP] = np.log1p(number)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        z = self.describe(texts) @ self.slopes + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def choose_landmarks(names: list[str], toxic: np.ndarray, clean: np.ndarray, documents: tuple[int, int], count: int) -> list[str]:
    """Tokens that mark toxic documents most, and for a third the commonest of clean ones, from the number of documents of either
    kind that have each token."""
    odds = np.where(toxic > 1, toxic * np.log((toxic + 0.5) / (documents[0] + 1) / ((clean + 0.5) / (documents[1] + 1))), -np.inf)
    best = np.argsort(-odds, kind="stable")[: 4 * count]
    best = sorted(best[np.isfinite(odds[best])].tolist(), key=lambda t: (-odds[t], names[t]))[: count * 2 // 3]
    common = sorted(np.argsort(-clean, kind="stable")[: 4 * count].tolist(), key=lambda t: (-clean[t], names[t]))
    return [names[t] for t in best] + [names[t] for t in common if t not in set(best) and clean[t]][: count - len(best)]


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = PENALTY, rounds: int = 30) -> tuple[np.ndarray, float]:
    """The least weighted squared hinge loss, by Newton's method on the rows within the margin, some of which are copied at a time."""
    w, shrink = np.zeros(x.shape[1] + 1), np.r_[np.full(x.shape[1], penalty), 1e-9]

    def margins(v: np.ndarray) -> np.ndarray:
        return x @ v[:-1].astype(np.float32) + np.float32(v[-1])

    def loss(v: np.ndarray) -> float:
        return float((weight * np.maximum(0, 1 - y * margins(v)) ** 2).sum() / len(y) + (shrink * v * v).sum())

    now = loss(w)
    for _ in range(rounds):
        inside = 1 - y * margins(w)
        on = np.flatnonzero(inside > 0)
        if not len(on):
            break
        grad, curve = shrink * w, np.diag(shrink)
        for at in range(0, len(on), ADDED):
            some = on[at : at + ADDED]
            rows = np.c_[x[some], np.ones(len(some), np.float32)]
            grad -= rows.T @ (weight[some] * y[some] * inside[some]) / len(y)
            rows *= np.sqrt(weight[some, None]).astype(np.float32)
            curve += (rows.T @ rows).astype(np.float64) / len(y)
        step = np.linalg.solve(curve, grad)
        size = 1.0
        while size > 1e-3 and loss(w - size * step) > now:
            size /= 2
        if size <= 1e-3 or now - (after := loss(w - size * step)) < 1e-7 * max(1e-9, now):
            break
        w, now = w - size * step, after
    return w[:-1], float(w[-1])


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and shift of a curve through (rows, label), by Newton's method with a little shrinkage."""
    x, theta = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        grad = x.T @ (p - y) + 1e-1 * theta
        theta -= np.linalg.solve((x.T * (p * (1 - p))) @ x + 1e-1 * np.eye(len(theta)), grad)
    return theta[:-1], float(theta[-1])


class _Sentences:
    """The sentences of labelled documents as token numbers. Nyström features are made only for the tokens of
    sentences that are trained on; the values of all others come from a table of subsequences."""

    def __init__(self, docs: Iterator[list[list[str]]]):
        place: dict[str, int] = {}
        flat, ends, owner = array("i"), array("q", [0]), array("i")
        for i, d in enumerate(docs):
            for s in d:
                flat.extend(place.setdefault(t, len(place)) for t in s)
                ends.append(len(flat))
                owner.append(i)
        self.names = list(place)
        self.flat, self.bounds, self.owner = np.array(flat, np.int32), np.array(ends, np.int64), np.array(owner, np.int32)
        self.slot = np.full(len(self.names), -1)
        self.made: list[np.ndarray] = []

    def documents_with(self, which: np.ndarray) -> np.ndarray:
        """In how many of the documents marked each token is."""
        doc = np.repeat(self.owner, np.diff(self.bounds))
        keep = which[doc]
        pairs = np.unique(doc[keep].astype(np.int64) * len(self.names) + self.flat[keep])
        return np.bincount(pairs % max(1, len(self.names)), minlength=len(self.names))

    def values(self, token_values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(token_values[self.flat], self.bounds[:-1])

    def features(self, pick: np.ndarray, landmarks: Landmarks, half: np.ndarray) -> np.ndarray:
        size = self.bounds[pick + 1] - self.bounds[pick]
        begin = np.cumsum(size) - size
        tokens = self.flat[np.repeat(self.bounds[pick] - begin, size) + np.arange(size.sum())]
        new = np.unique(tokens[self.slot[tokens] < 0])
        for at in range(0, len(new), ADDED):
            some = new[at : at + ADDED]
            self.slot[some] = sum(map(len, self.made)) + np.arange(len(some))
            self.made.append(landmarks.kernel([self.names[t] for t in some]) @ half)
        # features of all these tokens at once would be by far the most that training holds
        places, bounds = self.slot[tokens], np.r_[begin, len(tokens)]
        starts = np.cumsum([0, *map(len, self.made)])
        out = np.empty((len(pick), half.shape[1]), np.float32)
        lo = 0
        while lo < len(pick):
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + ADDED, "right")) - 1)
            some = places[bounds[lo] : bounds[hi]]
            block, rows = np.searchsorted(starts, some, "right") - 1, np.empty((len(some), half.shape[1]), np.float32)
            for b in np.unique(block):
                rows[block == b] = self.made[b][some[block == b] - starts[b]]
            out[lo:hi] = np.add.reduceat(rows, bounds[lo:hi] - bounds[lo], axis=0)
            lo = hi
        return out


def train(rows: list[tuple[str, int]], rounds: int = 4) -> Model:
    label = np.array([y for _, y in rows], np.int64)
    parts = _Sentences(sentences(tokenise(t)) for t, _ in rows)
    if len(np.unique(label[parts.owner])) < 2:
        return Model(np.zeros(SYMBOLS**LENGTH, np.float32), 0.0, np.zeros(TOP + 1), -40.0)
    toxic, clean = (parts.documents_with(label == y) for y in (1, 0))
    marks = choose_landmarks(parts.names, toxic, clean, (int(label.sum()), int((label == 0).sum())), LANDMARKS)
    landmarks = Landmarks(marks)
    values, vectors = np.linalg.eigh(landmarks.kernel(marks).astype(np.float64))
    keep = values > 1e-3 * values.max()
    half = (vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)  # K^(-1/2), the Nyström map
    owner = parts.owner
    bad = label[owner] == 1
    # the first guess at a toxic document's sentences: those with the marks of most weight
    weight = {t: 1 / (1 + i) for i, t in enumerate(marks[: LANDMARKS * 2 // 3])}
    value = parts.values(np.array([weight.get(t, 0.0) for t in parts.names]))
    chance = np.random.default_rng(1).random(len(owner))
    for r in range(rounds):
        order = np.lexsort((chance, -value, owner))
        first = np.r_[True, owner[order][1:] != owner[order][:-1]]
        rank = np.arange(len(order)) - np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
        # of a toxic document the first sentence, and the next ones that are toxic as well under the model so far
        also = (rank < TOP) & (value[order] > (LEAST_MARK if r == 0 else 0))
        positive = order[bad[order] & (first | also)]
        hard = order[first & ~bad[order]]
        loose = np.flatnonzero(~bad)
        loose = loose[np.argsort(chance[loose])][: 6 * int(label.sum())]
        pick = np.r_[positive, hard, loose]
        y = np.where(np.arange(len(pick)) < len(positive), 1.0, -1.0)
        w, b = svm(parts.features(pick, landmarks, half), y, np.where(y > 0, (y < 0).sum() / max(1, len(positive)), 1.0) * 0.5)
        model = Model(landmarks.table((half @ w).astype(np.float32)), b, np.zeros(TOP + 1), 0.0)
        value = parts.values(model.token_scores(parts.names)) + b
    del parts
    model.slopes, model.shift = logistic(model.describe([t for t, _ in rows]), np.array([y for _, y in rows], float))
    model.forget()
    return model


def score_column(spark: SparkSession, model: Model, text: Column) -> Column:
    from pyspark.sql.pandas.functions import arrow_udf

    shared = spark.sparkContext.broadcast(model)  # SYMBOLS^LENGTH floats, whatever the input

    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(shared.value.scores([t or "" for t in batch.to_pylist()]), pa.float64())

    scores.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(scores, DoubleType())(text)


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    return train(labelled_sample(documents, labels, "toxic", per_class))


def classify(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """documents, score (likelihood of being toxic) and predicted."""
    scored = documents.withColumn("score", score_column(documents.sparkSession, model, F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op7_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = classify(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
