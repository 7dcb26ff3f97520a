"""A quality classifier: supervised subword embeddings.

Words, pairs of words and character n-grams are hashed into buckets, each with a learnt
vector; a document is the mean of its vectors, and a softmax layer gives the class. It
is trained by stochastic gradient descent in numpy on a sample of labelled documents
whose size is a parameter. As mean and output layer are linear, the score of a document
is the mean over its features of one number a bucket, so that scoring needs a table of
2^BITS floats, the same at every size of corpus.

Defined results: null and empty texts score the bias alone; repeated rows score alike;
with no labelled rows every score is 0.5; added columns (score, predicted) replace
columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import held_out, labelled_sample
from .ngrams import Layout, bucket, groups, totals

BITS = 18
DIM = 12
CHAR_NGRAMS = (2, 3, 4)
#: Bound on the labelled documents of each class that the model is fitted on.
PER_CLASS = 1500
EPOCHS = 6
RATE = 40.0


@dataclass
class Model:
    table: np.ndarray
    bias: float

    def logits(self, texts: list[str]) -> np.ndarray:
        out = [np.zeros(0)]
        for run in groups(texts):
            x = Layout(run)
            total, count = np.zeros(len(run)), np.zeros(len(run))
            for buckets, lo, hi in features(x):
                total += totals(self.table[buckets], lo, hi)
                count += hi - lo
            out.append(total / np.maximum(1, count) + self.bias)
        return np.concatenate(out)

    def scores(self, texts: list[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(texts), -30, 30)))


def features(x: Layout) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of all features of a sort, and which of them each text has."""
    for n in CHAR_NGRAMS:
        yield bucket(x.grams(n), BITS, n), *x.spans(n)
    words = x.word_hashes()
    yield bucket(words, BITS, 101), x.words[:-1], x.words[1:]
    pairs = words[:-1] * np.uint64(0xA0761D6478BD642F) + words[1:]
    yield bucket(pairs, BITS, 102), x.words[:-1], np.maximum(x.words[:-1], x.words[1:] - 1)


def train(rows: list[tuple[str, int]], seed: int = 1) -> Model:
    """Softmax over two classes on mean vectors, by SGD over one document at a time."""
    if len({y for _, y in rows}) < 2:
        only = {y for _, y in rows}
        return Model(np.zeros(1 << BITS, np.float32), 0.0 if not only else (4.0 if only == {1} else -4.0))
    data = []
    for text, y in rows:
        for run in groups([text]):
            got = [b[lo[0] : hi[0]] for b, lo, hi in features(Layout(run))]
            found, n = np.unique(np.concatenate(got), return_counts=True)
            if len(found):
                data.append((found.astype(np.int32), (n / n.sum()).astype(np.float32), y))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, at = EPOCHS * len(data), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(data)):
            found, share, y = data[i]
            rate = RATE * (1 - at / steps)
            mean = share @ vectors[found]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= 0.02 * rate * np.outer(mean, p)
            bias -= 0.002 * rate * p
            vectors[found] -= rate * share[:, None] * back
            at += 1
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def score_column(spark, model: Model, text: Column) -> Column:
    from pyspark.sql.pandas.functions import arrow_udf

    shared = spark.sparkContext.broadcast(model)  # 2^BITS floats, whatever the input

    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(shared.value.scores([t or "" for t in batch.to_pylist()]), pa.float64())

    scores.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(scores, DoubleType())(text)


def fit(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    return train(labelled_sample(documents, labels, "quality", per_class))


def classify(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """documents, score (likelihood of good quality) and predicted."""
    scored = documents.withColumn("score", score_column(documents.sparkSession, model, F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op2_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = classify(documents.select("doc_id", "text"), fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
