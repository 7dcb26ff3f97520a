"""Language identification by multilingual mixture inference.

For each language that documents are marked with, hashed character n-gram frequencies
are counted on a sample of documents. A document is then a mixture: expectation
maximisation over its words, each with the likelihood of its n-grams under every
language, estimates the proportions until they move by less than TOLERANCE. Language sets
of one, two and more languages, taken by descending proportion, are fitted in turn for as
long as the penalised likelihood (half the logarithm of the number of words for each free
proportion) rises, up to all languages learnt. The prediction is the language of most
weight in the set selected. Documents in which no mixture can outweigh the penalty, as no
word is that much likelier in another language, skip the fitting.

The model has a column for each of the MOST_CODES most frequent language codes.

Defined results: null texts and texts without a letter are `und` with score 0, and so is
every text where nothing could be learnt; ties go to the language of least code;
repeated rows score alike; added columns replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from .common import held_out, learnable, least_hashed, short_enough
from .ngrams import Layout, bucket, groups, totals

BITS = 16
NGRAMS = (1, 2, 3)
#: Bound on the documents of each language from which n-grams are counted.
PER_LANGUAGE = 800
#: Bound on the languages that are learnt, by which the model is small enough to broadcast.
MOST_CODES = 128
TOLERANCE = 1e-3
MOST_ROUNDS = 200
SMOOTHING = 0.5
UNKNOWN = "und"
RESULT = StructType([StructField("lang", StringType()), StructField("score", DoubleType()), StructField("languages", ArrayType(StructType([StructField("lang", StringType()), StructField("share", DoubleType())])))])


def _layout(run: list[str]) -> Layout:
    """Every text stands between blanks, and all blanks are alike."""
    x = Layout([f" {t} " for t in run])
    x.codes[(x.codes >= 9) & (x.codes <= 13)] = 32
    return x


@dataclass
class Model:
    languages: list[str]
    #: log p(n-gram | language): a row for each bucket.
    logs: np.ndarray

    def word_logs(self, x: Layout) -> np.ndarray:
        """Log likelihood under each language of the n-grams that begin in each word."""
        logs = np.zeros((len(x.codes), len(self.languages)), np.float32)
        for n in NGRAMS:
            h = bucket(x.grams(n), BITS, n)
            logs[: len(h)] += self.logs[h]
        if not len(x.word_starts):
            return np.zeros((0, len(self.languages)), np.float32)
        ends = np.c_[x.word_starts, x.word_ends].ravel()  # a text ends with a blank, so the last end is a position too
        return np.add.reduceat(logs, ends, axis=0)[::2]

    def infer(self, texts: list[str]) -> list[tuple[str, float, list[dict]]]:
        found = []
        for run in groups(texts):
            lettered = [any(map(str.isalpha, t)) for t in run]
            x = _layout(run)
            shares, chosen = mixtures(self.word_logs(x), x.words)
            for ok, share, own in zip(lettered, shares, chosen, strict=True):
                if not ok or not self.languages:
                    found.append((UNKNOWN, 0.0, []))
                    continue
                order = [k for k in np.argsort(-share, kind="stable") if own[k]]
                found.append((self.languages[order[0]], float(min(1.0, share[order[0]])), [{"lang": self.languages[k], "share": float(share[k])} for k in order]))
        return found


def _expectation(near: np.ndarray, bounds: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages in each document, fitted until they stay, and the likelihood then."""
    n = np.diff(bounds)
    share = (allowed / allowed.sum(axis=1, keepdims=True)).astype(np.float64)
    moving = np.flatnonzero(n > 0)
    held = None
    for _ in range(MOST_ROUNDS):
        if not len(moving):
            break
        if held is None or len(moving) < 0.7 * len(held):
            held = moving
            start = np.cumsum(n[held]) - n[held]
            own = near[np.repeat(bounds[:-1][held] - start, n[held]) + np.arange(n[held].sum())]
            who = np.repeat(np.arange(len(held)), n[held])
        part = own * share[held][who]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        now = np.add.reduceat(part, start, axis=0) / n[held, None]
        moved = np.abs(now - share[held]).max(axis=1)
        share[held] = now
        moving = held[moved > TOLERANCE]
    whole = np.maximum((near * share[np.repeat(np.arange(len(n)), n)]).sum(axis=1), 1e-300)
    return share, totals(np.log(whole), bounds[:-1], bounds[1:])


def mixtures(logs: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each document (words bounds[i] to bounds[i + 1]): language shares, and the selected set."""
    docs, langs = len(bounds) - 1, logs.shape[1]
    if not langs:
        return np.zeros((docs, 0)), np.zeros((docs, 0), bool)
    n = np.diff(bounds)
    top = logs.max(axis=1, keepdims=True) if len(logs) else logs[:, :1]
    alone = totals(logs - top, bounds[:-1], bounds[1:])
    best = np.argmax(alone, axis=1)
    own = np.zeros((docs, langs), bool)
    own[np.arange(docs), best] = True
    share, value = own.astype(float), alone[np.arange(docs), best]
    penalty = 0.5 * np.log(np.maximum(2, n))
    # the likelihood of a mixture is 0 at most
    open_ = np.flatnonzero((n > 0) & (-value > penalty))
    if langs < 2 or not len(open_):
        return share, own
    start = np.r_[0, np.cumsum(n[open_])]
    near = np.exp((logs - top)[np.repeat(bounds[:-1][open_] - start[:-1], n[open_]) + np.arange(start[-1])].astype(np.float64))
    everything, _ = _expectation(near, start, np.ones((len(open_), langs)))
    rank = np.argsort(np.argsort(-everything, axis=1, kind="stable"), axis=1)
    for size in range(2, langs + 1):
        allowed = rank < size
        mixed, likelihood = _expectation(near, start, allowed.astype(float))
        penalised = likelihood - (size - 1) * penalty[open_]
        better = penalised > value[open_] + 1e-9
        on = open_[better]
        own[on], share[on], value[on] = allowed[better], mixed[better], penalised[better]
        # larger sets only where this one was better
        keep = np.repeat(better, n[open_])
        near, rank, open_ = near[keep], rank[better], on
        start = np.r_[0, np.cumsum(n[open_])]
        if not len(open_):
            break
    return share, own


def train(rows: list[tuple[str, str]]) -> Model:
    languages = sorted({lang for _, lang in rows})
    counts = np.zeros((1 << BITS, len(languages)))
    for k, lang in enumerate(languages):
        for run in groups([t for t, x in rows if x == lang]):
            x = _layout(run)
            for n in NGRAMS:
                counts[:, k] += np.bincount(bucket(x.grams(n), BITS, n), minlength=1 << BITS)
    logs = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * (1 << BITS))
    return Model(languages, logs.astype(np.float32))


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Counted on the per_language documents of each language of least hashed id, of those up to SAMPLE_CHARS characters."""
    marked = documents.where(learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull() & short_enough())
    chosen = least_hashed(marked.select("doc_id", "lang"), "lang", per_language, MOST_CODES).distinct()
    # per_language ids for each of MOST_CODES codes at most: a size that does not grow with the input
    rows = marked.select("doc_id", "text", "lang").join(F.broadcast(chosen), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text")).collect()
    return train([(r["text"], r["lang"]) for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"]))])


def language_column(spark: SparkSession, model: Model, text: Column) -> Column:
    """A struct of lang, score and languages (those selected, with their shares)."""
    from pyspark.sql.pandas.functions import arrow_udf

    shared = spark.sparkContext.broadcast(model)  # 2^BITS rows, a column for each of at most MOST_CODES languages
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())])))])

    def infer(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([dict(zip(("lang", "score", "languages"), r, strict=True)) for r in shared.value.infer([t or "" for t in batch.to_pylist()])], kind)

    infer.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(infer, RESULT)(text)


def op6_langid(documents: DataFrame) -> DataFrame:
    found = language_column(documents.sparkSession, fit(documents), F.col("text"))
    out = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("__found"))
    return out.select("doc_id", "held_out", F.col("__found.lang").alias("lang_pred"), F.col("__found.score").alias("score"), F.to_json("__found.languages").alias("languages"))
