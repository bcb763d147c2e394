"""A quality classifier on random-indexing word vectors.

Every word of a bounded vocabulary has a sparse random index vector; its word vector is the damped,
normalised sum of the index vectors of the words within two places of it, over the fitting sample.
Words outside the vocabulary are taken by their shape (case, digits, symbols, length), a word that
repeats the one before counts as a repetition. A document's vector is the mean of its words'
vectors and their spread. A two-layer network in numpy gives the logit of label 1; a temperature
fitted on documents that the network was not trained on calibrates its probabilities.

The classifier is fitted on a bounded sample of labelled rows (``most_rows``, on average at most).
Scoring covers every whole text.

Defined results: null and empty texts have the zero vector and get the network's score for it; rows
without label are not learned from; without labelled rows every score is 0.5, with only one label
it is that label's smoothed share.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamiz.llm.base import map_batches, narrow, own_columns, texts
from tamiz.llm.bpe import _Places
from tamiz.session import materialize

MOST_ROWS = 6000
VOCABULARY = 4096
DIMENSIONS, NONZERO, REACH = 64, 6, 2
HIDDEN, EPOCHS, RATE, DECAY = 32, 400, 0.01, 1e-4
TOKEN = re.compile(r"\w+|[^\w\s]+")
REPEATED = "<again>"


def shape(token: str) -> str:
    """A coarse class of a word: case, digits or symbols, and length."""
    if not (token[0].isalnum() or token[0] == "_"):
        return f"<sign {min(len(token), 4)}>"
    if token.isdigit():
        return f"<digits {min(len(token), 6)}>"
    case = "upper" if token.isupper() and len(token) > 1 else "title" if token[0].isupper() else "lower"
    return f"<{case} {min(len(token) // 3, 6)}>"


class Vectors:
    """Ids of words and shapes, and their vectors once learned."""

    def __init__(self, words: list[str], seed: int = 0):
        self.ids = {w: i + 1 for i, w in enumerate(words)}
        self.ids[REPEATED] = 0
        self.size = len(self.ids) + 64  # shapes are hashed on the places after the words
        rng = np.random.Generator(np.random.PCG64(seed))
        self.index = np.zeros((self.size, DIMENSIONS), np.float32)
        for row in self.index:
            row[rng.choice(DIMENSIONS, NONZERO, replace=False)] = rng.choice([-1.0, 1.0], NONZERO)
        self.shapes: dict[str, int] = {}
        self.table = self.index

    def _id(self, token: str) -> int:
        known = self.ids.get(token)
        if known is not None:
            return known
        kind = shape(token)
        code = 0
        for c in kind:
            code = (code * 131 + ord(c)) % 1_000_003
        return len(self.ids) + code % 64

    def tokens(self, items: list[str]) -> list[np.ndarray]:
        """Ids of each text's tokens."""
        places = _Places()
        found = [np.fromiter(map(places.__getitem__, TOKEN.findall(t)), np.int64) for t in items]
        ids = np.array([self._id(t) for t in places], np.int64)
        out = []
        for at in found:
            own = ids[at] if len(at) else np.zeros(0, np.int64)
            own[1:][at[1:] == at[:-1]] = 0
            out.append(own)
        return out

    def context_sums(self, items: list[str]) -> np.ndarray:
        """Index vectors of all neighbours, summed per word."""
        sums = np.zeros((self.size, DIMENSIONS), np.float64)
        for ids in self.tokens(items):
            for step in range(1, REACH + 1):
                if len(ids) > step:
                    np.add.at(sums, ids[:-step], self.index[ids[step:]])
                    np.add.at(sums, ids[step:], self.index[ids[:-step]])
        return sums

    def learn(self, sums: np.ndarray) -> None:
        """Damp, add the word's own index vector and bring to length one."""
        damped = np.sign(sums) * np.log1p(np.abs(sums)) + self.index
        self.table = (damped / np.maximum(1e-9, np.linalg.norm(damped, axis=1, keepdims=True))).astype(np.float32)

    def pool(self, items: list[str]) -> np.ndarray:
        """Mean and spread of the word vectors of each text."""
        out = np.zeros((len(items), 2 * DIMENSIONS), np.float32)
        for i, ids in enumerate(self.tokens(items)):
            if len(ids):
                counts = np.bincount(ids)
                used = np.flatnonzero(counts)
                rows, share = self.table[used], (counts[used] / len(ids)).astype(np.float32)
                mean = share @ rows
                out[i, :DIMENSIONS] = mean
                out[i, DIMENSIONS:] = np.sqrt(np.maximum(0, share @ (rows * rows) - mean * mean))
        return out


class Network:
    """Two layers; ``temperature`` divides the logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 0):
        rng = np.random.Generator(np.random.PCG64(seed))
        order = rng.permutation(len(y))
        held, used = order[: len(y) // 5], order[len(y) // 5:]
        self.mean, self.spread = x[used].mean(axis=0), x[used].std(axis=0) + 1e-3
        d = x.shape[1]
        self.w = [
            rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN),
            np.zeros(1),
        ]
        self.temperature = 1.0
        self._train((x[used] - self.mean) / self.spread, y[used])
        if len(held):
            logits, truth = self.logits(x[held]), y[held]
            # Smoothed targets keep the temperature from vanishing when every held-out row is right.
            ones = truth.sum()
            target = np.where(truth == 1, (ones + 1) / (ones + 2), 1 / (len(truth) - ones + 2))
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
            losses = [
                np.mean(target * np.logaddexp(0, -logits / t) + (1 - target) * np.logaddexp(0, logits / t))
                for t in grid
            ]
            self.temperature = float(grid[int(np.argmin(losses))])

    def _train(self, x, y):
        first = [np.zeros_like(w) for w in self.w]
        second = [np.zeros_like(w) for w in self.w]
        for step in range(1, EPOCHS + 1):
            hidden = np.maximum(0, x @ self.w[0] + self.w[1])
            error = (1 / (1 + np.exp(-np.clip(hidden @ self.w[2] + self.w[3], -30, 30))) - y) / len(y)
            back = np.outer(error, self.w[2]) * (hidden > 0)
            grads = [x.T @ back, back.sum(axis=0), hidden.T @ error, error.sum(keepdims=True)]
            for i, grad in enumerate(grads):
                grad = grad + DECAY * self.w[i]
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad * grad
                self.w[i] = self.w[i] - RATE * (first[i] / (1 - 0.9**step)) / (
                    np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
                )

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(0, ((x - self.mean) / self.spread) @ self.w[0] + self.w[1])
        return hidden @ self.w[2] + self.w[3]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


class Classifier:
    """Vectors and network, or a constant where there was nothing to learn."""

    def __init__(self, vectors: Vectors | None, network: Network | None, constant: float = 0.5):
        self.vectors, self.network, self.constant = vectors, network, constant

    def score(self, items: list[str]) -> np.ndarray:
        if self.network is None:
            return np.full(len(items), self.constant)
        # Rounded, so that equal texts score equally whatever stands beside them in a batch.
        return np.round(self.network.probabilities(self.vectors.pool(items).astype(np.float64)), 9)


def fit(
    docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", doc_id: str = "doc_id",
    text: str = "text", most_rows: int = MOST_ROWS,
) -> Classifier:
    """Learn ``label`` from rows of ``labels`` where ``learn`` (of the id) holds."""
    known = labels.filter(learn & F.col(label).isNotNull()).select(
        F.col(doc_id).alias("labelled"), F.col(label).cast("int").alias("label")
    )
    rows = known.count()
    drawn = F.pmod(F.xxhash64("labelled"), F.lit(1_000_000)) < min(1.0, most_rows / max(1, rows)) * 1_000_000
    chosen = materialize(known.filter(drawn), "labels")
    joined = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        chosen, F.col("id") == F.col("labelled")
    )
    sample = materialize(joined.select("id", "text", "label"), "labelled-texts")

    def count(batches):
        seen: Counter[str] = Counter()
        for batch in narrow(batches, "text"):
            for item in texts(batch.column(0)):
                seen.update(set(TOKEN.findall(item)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"]
        )

    frequent = sample.select("text").mapInArrow(count, "token string, n long").groupBy("token").agg(
        F.sum("n").alias("n")
    ).filter("n > 1").orderBy(F.desc("n"), "token").limit(VOCABULARY)
    vectors = Vectors([r.token for r in frequent.select("token").collect()])
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def contexts(batches):
        sums = 0
        for batch in narrow(batches, "text"):
            sums = sums + sent.value.context_sums(texts(batch.column(0)))
        if not isinstance(sums, int):
            cells = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int64()), pa.array(sums.ravel()[cells])], names=["cell", "n"]
            )

    # One row per word and dimension, whatever the number of documents.
    summed = sample.select("text").mapInArrow(contexts, "cell long, n double").groupBy("cell").agg(
        F.sum("n").alias("n")
    ).toArrow()
    sums = np.zeros(vectors.size * DIMENSIONS)
    sums[summed.column(0).to_numpy()] = summed.column(1).to_numpy()
    vectors.learn(sums.reshape(-1, DIMENSIONS))
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(batch):
        pool = sent.value.pool(texts(batch.column(1)))
        return {
            "id": batch.column(0), "label": batch.column(2),
            "pool": pa.FixedSizeListArray.from_arrays(pa.array(pool.ravel()), pool.shape[1]).cast(pa.list_(pa.float32())),
        }

    kind = dict(sample.dtypes)["id"]
    points = map_batches(sample, "text", pooled, f"id {kind}, label int, pool array<float>").orderBy("id", "label").toArrow()
    if not len(points):
        return Classifier(None, None)
    y = points.column(1).to_numpy().astype(float)
    if len(set(y)) < 2:
        return Classifier(None, None, float((y.sum() + 1) / (len(y) + 2)))
    x = np.array(points.column(2).to_pylist(), np.float64)
    return Classifier(vectors, Network(x, y))


def classify(docs: DataFrame, model: Classifier, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score``, the calibrated probability of label 1, to all columns; a same name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary
    docs = docs.select(*(F.col(f"`{c}`") for c in own_columns(docs, (score,))))

    def run(batch):
        out = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
        out[score] = shared.value.score(texts(batch.column(text)))
        return out

    return map_batches(
        docs, text, run, T.StructType(docs.schema.fields + [T.StructField(score, T.DoubleType())])
    )
