"""Quality classifier on supervised subword embeddings.

Hashed word and character n-gram vectors are averaged per document and go to a
softmax; numpy stochastic gradient descent trains them on a bounded sample of
labelled rows.  The trained layers are linear, so a document's score is the average
of its words' scores, and whole texts of any length cost one lookup a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import batches_by_bytes, narrow, raw_texts
from riskweave.llm.word_features import BUCKETS, Featuriser, WordScores, labelled_sample, logistic

#: Most labelled rows that training reads.
SAMPLE = 5_000
DIMENSIONS, EPOCHS, RATE = 8, 6, 0.4
#: Steps that training takes at least: small samples are read more often.
STEPS = 12_000
#: Stands in for the second of two equal neighbouring words: the word bigram of a repetition.
AGAIN = b"\x00again"


def tokens(text: bytes) -> list[bytes]:
    words = text.lower().split()
    return words + [AGAIN] * sum(map(bytes.__eq__, words, words[1:]))


class QualityModel:
    """Two-class softmax over averaged bucket vectors."""

    def __init__(self, vectors: np.ndarray, output: np.ndarray, bias: np.ndarray):
        self.table = vectors @ (output[1] - output[0])
        self.bias = float(bias[1] - bias[0])
        self._scores: WordScores | None = None

    def __getstate__(self) -> dict:
        return {"table": self.table, "bias": self.bias, "_scores": None}

    def score(self, text: bytes) -> float:
        """Probability of label 1; a text without words has the score of the bias."""
        if self._scores is None:
            self._scores = WordScores(self.table)
        words = tokens(text)
        mean = sum(map(self._scores.__getitem__, words)) / len(words) if words else 0.0
        return logistic(mean + self.bias)


def train(sample: list[tuple[bytes, int]], seed: int = 11) -> QualityModel:
    """Stochastic gradient descent with a falling rate; steps are scaled by the length of the input."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output, bias = np.zeros((2, DIMENSIONS)), np.zeros(2)
    build = Featuriser()
    inputs = [(*build.text(tokens(text)), label) for text, label in sample]
    epochs = max(EPOCHS, STEPS // max(len(inputs), 1))
    steps, done = epochs * max(len(inputs), 1), 0
    for _ in range(epochs if inputs else 0):
        for at in rng.permutation(len(inputs)):
            ids, weights, label = inputs[at]
            rate = RATE * (1 - done / steps)
            done += 1
            rows = vectors[ids]
            hidden = weights @ rows
            z = output @ hidden + bias
            share = np.exp(z - z.max())
            error = share / share.sum() - np.array([label != 1, label == 1])
            back = error @ output
            output -= rate * np.outer(error, hidden) / max(hidden @ hidden, 1e-2)
            bias -= 0.1 * rate * error
            if len(ids):
                vectors[ids] = rows - (rate / (weights @ weights)) * np.outer(weights, back)
    return QualityModel(vectors, output, bias)


def _score(shared, at: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches_by_bytes(batches, "text", 2 << 20):
            scores = np.array([model.score(t) for t in raw_texts(batch.column("text"))], np.float64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scores), "predicted": pa.array((scores >= at).astype(np.int32))})

    return run


def quality_scores(docs: DataFrame, model: QualityModel, at: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (probability of label 1), predicted (score >= at) of every row, whole texts.

    Null text counts as empty; empty texts get a score too.  Rows repeat as they come.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return narrow(docs, id_col, text_col).mapInArrow(_score(shared, at), "doc_id long, score double, predicted int")


def fit_quality(docs: DataFrame, labels: DataFrame, usable, label: str = "quality", sample: int = SAMPLE) -> QualityModel:
    """Model from at most `sample` labelled rows for which `usable(id column name)` holds.

    Without labelled rows every score is one half.
    """
    return train(labelled_sample(docs, labels, label, lambda c: F.coalesce(usable(c), F.lit(False)), sample))
