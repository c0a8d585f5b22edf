"""Counterfactual-regularised toxicity classifier.

Every word has a log weight, the scaled average of its hashed word and character
n-gram buckets; a text's logit is a bias plus the log of one plus the sum of its
words' weights, so that few toxic words count however long the text is.  The
model is trained on labelled texts and on counterfactual pairs: identity terms of
a text are swapped for others of their kind, and a neutral text that names none
has one word replaced by a term.  The squared difference of a pair's logits is
penalised, so that naming a group moves no score by itself.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import batches_by_bytes, narrow, raw_texts
from riskweave.llm.word_features import BUCKETS, Vocabulary, WordScores, labelled_sample, logistic

#: Most labelled rows that training reads.
SAMPLE = 6_000
EPOCHS, RATE, PULL = 4, 0.3, 2.0
#: Steps that training takes at least: small samples are read more often.
STEPS = 12_000
#: Log weight of a word that training never met, and how much an average of buckets moves it.
REST, SCALE = -6.0, 8.0
#: Bounds of a log weight.
LOWEST, HIGHEST = -30.0, 30.0
#: Terms that can stand for each other, by kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic", "muslime", "christen", "juden", "musulmans", "chrétiens", "juifs", "musulmanes", "cristianos", "judíos"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "mexican", "chinese", "indian", "turkish", "polish"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "homosexual", "heterosexual"),
    ("immigrants", "refugees", "migrants", "foreigners", "natives", "ausländer", "flüchtlinge", "étrangers", "réfugiés", "inmigrantes", "refugiados"),
    ("disabled", "deaf", "blind", "elderly", "young", "old", "poor", "rich"),
)


def tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def _kinds() -> dict[bytes, list[bytes]]:
    return {t.encode(): [o.encode() for o in group if o != t] for group in IDENTITY_TERMS for t in group}


class ToxicityModel:
    def __init__(self, table: np.ndarray, bias: float):
        self.table, self.bias = table, bias
        self._weights: WordWeights | None = None

    def __getstate__(self) -> dict:
        return {"table": self.table, "bias": self.bias, "_weights": None}

    def score(self, text: bytes) -> float:
        """Probability that a text is toxic; a text without words has the score of the bias."""
        if self._weights is None:
            self._weights = WordWeights(self.table)
        return logistic(self.bias + math.log1p(sum(map(self._weights.__getitem__, tokens(text)))))

    def forget(self) -> None:
        """Frees the remembered words."""
        self._weights = None


class WordWeights(WordScores):
    """Weight of a word, remembered."""

    def __missing__(self, word: bytes) -> float:
        self[word] = weight = math.exp(min(max(REST + SCALE * super().__missing__(word), LOWEST), HIGHEST))
        return weight


def counterfactual(counts: Counter, rng: np.random.Generator, kinds: dict[bytes, list[bytes]]) -> list[tuple[bytes, bytes, int]]:
    """Swaps (word, other word, copies) that make a text's counterfactual."""
    named = [w for w in counts if w in kinds]
    if named:
        return [(w, kinds[w][rng.integers(len(kinds[w]))], counts[w]) for w in named]
    if not counts:
        return []
    terms, words = list(kinds), list(counts)
    return [(words[rng.integers(len(words))], terms[rng.integers(len(terms))], 1)]


def train(sample: list[tuple[bytes, int]], seed: int = 5, pull: float = PULL) -> ToxicityModel:
    """Adaptive gradient steps on the log loss plus `pull` times the squared logit change of a swap.

    Only neutral texts get a word replaced where they name no group; a toxic text keeps its words.
    """
    rng = np.random.default_rng(seed)
    kinds, words = _kinds(), Vocabulary()
    table, seen = np.zeros(BUCKETS), np.full(BUCKETS, 1e-3)
    bias, bias_seen = -2.0, 1e-1
    for term in kinds:
        words.number(term)
    inputs = [(*words.counted(tokens(text)), label) for text, label in sample]
    words.freeze()

    def log_weight(buckets: np.ndarray) -> float:
        return min(max(REST + SCALE * float(table[buckets].mean()), LOWEST), HIGHEST)

    def step(buckets: np.ndarray, slope: float, rate: float) -> None:
        ids, copies = np.unique(buckets, return_counts=True)
        slopes = slope * SCALE / len(buckets) * copies
        seen[ids] += slopes * slopes
        table[ids] -= rate * slopes / np.sqrt(seen[ids])

    epochs = max(EPOCHS, STEPS // max(len(inputs), 1))
    for epoch in range(epochs if inputs else 0):
        rate = RATE * (1 - epoch / epochs)
        for at in rng.permutation(len(inputs)):
            own, counts, label = inputs[at]
            total, slopes = 0.0, np.zeros(0)
            if len(own):
                buckets, begins = words.together(own)
                sizes = words.size[own].astype(np.int64)
                means = np.add.reduceat(table[buckets], begins) / sizes
                slopes = counts.astype(np.float64) * np.exp(np.clip(REST + SCALE * means, LOWEST, HIGHEST))
                total = float(slopes.sum())
                slopes /= 1 + total
            error = logistic(bias + math.log1p(total)) - label
            for i in np.flatnonzero(np.abs(error) * slopes > 1e-4).tolist():
                step(words.buckets(own[i]), error * slopes[i], rate)
            bias_seen += error * error
            bias -= rate * error / np.sqrt(bias_seen)
            if not pull or (label == 1 and not (own < len(kinds)).any()):
                continue
            named = Counter(dict(zip(map(words.names.__getitem__, own.tolist()), counts.tolist(), strict=True)))
            for word, other, copies in counterfactual(named, rng, kinds):
                here, there = words.buckets(words.number(word)), words.buckets(words.number(other))
                less, more = copies * math.exp(log_weight(here)), copies * math.exp(log_weight(there))
                rest = max(total - less, 0.0)
                change = math.log1p(rest + more) - math.log1p(rest + less)
                step(there, 2 * pull * change * more / (1 + rest + more), rate)
                step(here, -2 * pull * change * less / (1 + rest + less), rate)
    return ToxicityModel(table, bias)


def _score(shared, at: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches_by_bytes(batches, "text", 2 << 20):
            scores = np.array([model.score(t) for t in raw_texts(batch.column("text"))], np.float64)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "score": pa.array(scores), "predicted": pa.array((scores >= at).astype(np.int32))})

    return run


def toxicity_scores(docs: DataFrame, model: ToxicityModel, at: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (probability of label 1), predicted (score >= at) of every row, whole texts.

    Null text counts as empty; empty texts get a score too.  Rows repeat as they come.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return narrow(docs, id_col, text_col).mapInArrow(_score(shared, at), "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: ToxicityModel, at: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that score below `at`, with all their columns.

    Only the text goes to Python, and one boolean comes back; a task forgets its words at its end.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def fine(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for column in columns:
                parts = batches_by_bytes(iter([pa.record_batch({"text": column})]), "text", 2 << 20)
                yield pa.array([shared.value.score(t) < at for part in parts for t in raw_texts(part.column("text"))], pa.bool_())
        finally:
            shared.value.forget()

    return docs.filter(fine(F.col(text_col).cast("string")))


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable, label: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Model from at most `sample` labelled rows for which `usable(id column name)` holds.

    Without labelled rows every score is one half.
    """
    return train(labelled_sample(docs, labels, label, lambda c: F.coalesce(usable(c), F.lit(False)), sample))
