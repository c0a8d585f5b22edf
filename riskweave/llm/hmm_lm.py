"""Hidden Markov language model.

A text is a chain of hidden states; a state emits a word class, a class its word.
The most frequent words are classes of their own; all other words share a class
with those that end alike, and follow their add-one share within it.  Baum-Welch
counts are gathered inside the tasks and summed by Spark; the scaled forward
recursion gives the exact likelihood of a whole text.

Nothing that grows with the vocabulary is broadcast: at most `LOCAL` words travel
to the tasks, and counts of all rarer words are joined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import batches_by_bytes, narrow, raw_texts, stored

#: Word that stands for the end of a text.
END = b""
#: Most words that are classes of their own, and classes shared by the others (by their last bytes).
OWN, SHARED, SUFFIX = 61_440, 4_096, 3
CLASSES = OWN + SHARED
#: Most words whose counts travel to the tasks.
LOCAL = 1 << 18
STATES = 8
ROUNDS = 6
#: Training reads texts in stretches of so many tokens; scoring reads them whole.
STRETCH = 256
#: Tokens whose weight a state's emissions share with the corpus-wide shares.
PRIOR = 400.0


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        return pa.record_batch({"word": pa.array(list(counts), pa.binary()), "n": pa.array(list(counts.values()), pa.int64())})

    for batch in batches:
        for text in raw_texts(batch.column("text")):
            counts.update(text.lower().split())
            counts[END] += 1
            if len(counts) > 400_000:
                yield flush()
                counts.clear()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """Occurrences of every word, and of the end of a text, in the rows of (doc_id, text)."""
    return texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _threshold(counts: DataFrame, most: int) -> int:
    """Smallest count that at most `most` words reach.  Large counts are rounded to three digits first."""
    power = F.pow(F.lit(10.0), F.greatest(F.floor(F.log10("n")) - 2, F.lit(0))).cast("long")
    steps = counts.select((F.floor(F.col("n") / power) * power).alias("n")).groupBy("n").count().collect()
    total, least = 0, 1
    for n, words in sorted(((r[0], r[1]) for r in steps), reverse=True):
        if total + words > most:
            return least if total else int(n) + 1
        total, least = total + words, int(n)
    return 1


class Vocabulary:
    """Words whose counts tasks know, with classes, and figures of the shared classes."""

    def __init__(self, words: list[bytes], counts: np.ndarray, own_from: int, tail_tokens: np.ndarray, tail_words: np.ndarray, tokens: int, distinct: int):
        self.words, self.counts = words, counts
        own = np.flatnonzero(counts >= own_from)
        self.classes = np.array([OWN + zlib.crc32(w[-SUFFIX:]) % SHARED for w in words], np.int64)
        self.classes[own] = np.arange(len(own))
        self.log_count = np.log10(counts + 1.0)
        self.shared_norm = np.log10(tail_tokens + tail_words + 1.0)
        self.tokens, self.distinct = tokens, distinct
        self.class_tokens = np.concatenate([np.zeros(OWN), tail_tokens])
        self.class_tokens[self.classes[own]] = counts[own]

    def lookup(self) -> dict[bytes, int]:
        return _Known(zip(self.words, range(len(self.words)), strict=True))


class _Known(dict):
    def __missing__(self, _: bytes) -> int:
        return -1


def vocabulary(counts: DataFrame, own: int = OWN, local: int = LOCAL) -> Vocabulary:
    """The bounded part of stored word counts."""
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    own_from, local_from = _threshold(counts, own), _threshold(counts, local)
    tail = (
        counts.filter(F.col("n") < own_from)
        .groupBy((F.crc32(F.expr(f"substring(word, -{SUFFIX}, {SUFFIX})")) % SHARED).cast("int").alias("k"))
        .agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    ).collect()
    tokens, words = np.zeros(SHARED), np.zeros(SHARED)
    for r in tail:
        tokens[r["k"]], words[r["k"]] = r["n"], r["words"]
    known = counts.filter(F.col("n") >= min(local_from, own_from)).toArrow().sort_by("word")
    return Vocabulary(known["word"].to_pylist(), known["n"].to_numpy().astype(np.float64), own_from, tokens, words, totals[0], totals[1])


_lookups: dict[int, tuple[Vocabulary, dict]] = {}


def _known(shared) -> tuple[Vocabulary, dict]:
    """The broadcast vocabulary and its dictionary, built once a worker process."""
    if shared.value is not _lookups.get(0, (None,))[0]:
        _lookups[0] = (shared.value, shared.value.lookup())
    return _lookups[0]


_ENCODED = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, log_within double, seq binary, rare array<struct<word:binary,n:long>>"


def _encode(shared):
    """Documents as class sequences; words that tasks do not know are listed for the join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, known = _known(shared)
        at, done = known.__getitem__, TaskContext.get().partitionId() << 33
        for batch in batches_by_bytes(batches, "text", 4 << 20):
            out = {c: [] for c in ("n_tokens", "n_known", "log_counts", "log_within", "seq", "rare")}
            for text in raw_texts(batch.column("text")):
                words = text.lower().split()
                words.append(END)
                rows = np.fromiter(map(at, words), np.int64, len(words))
                strange = np.flatnonzero(rows < 0)
                classes = vocab.classes[rows] if len(vocab.words) else np.zeros(len(rows), np.int64)
                logs = vocab.log_count[rows] if len(vocab.words) else np.zeros(len(rows))
                logs[strange] = 0
                rare = Counter(words[i] for i in strange.tolist())
                if len(strange):
                    classes[strange] = [OWN + zlib.crc32(words[i][-SUFFIX:]) % SHARED for i in strange.tolist()]
                tail = classes >= OWN
                out["n_tokens"].append(len(words))
                out["n_known"].append(len(words) - len(strange))
                out["log_counts"].append(logs.sum())
                out["log_within"].append(logs[tail].sum() - vocab.shared_norm[classes[tail] - OWN].sum())
                out["seq"].append(classes.astype("<u2").tobytes())
                out["rare"].append([{"word": w, "n": n} for w, n in rare.items()])
            size = batch.num_rows
            columns = {"key": pa.array(np.arange(done, done + size)), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out")}
            columns |= {c: pa.array(out[c], pa.int64()) for c in ("n_tokens", "n_known")} | {c: pa.array(out[c], pa.float64()) for c in ("log_counts", "log_within")}
            columns |= {"seq": pa.array(out["seq"], pa.binary()), "rare": pa.array(out["rare"], pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))}
            yield pa.record_batch(columns)
            done += size

    return run


class Model:
    """Start, step and emission shares of the hidden states."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray):
        self.start, self.step, self.emit = start, step, emit


def _corpus_shares(vocab: Vocabulary) -> np.ndarray:
    smooth = vocab.class_tokens + 1.0
    return smooth / smooth.sum()


def first_model(vocab: Vocabulary, states: int = STATES, seed: int = 7) -> Model:
    """Seeded noise around the corpus-wide shares; states tend to last."""
    noise = np.exp(np.random.default_rng(seed).normal(0, 1.0, (CLASSES, states)))
    emit = _corpus_shares(vocab)[:, None] * noise
    step = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(step, 0.9)
    return Model(np.full(states, 1 / states), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def expected_counts(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of sequences of one stretch or less: start, step, classes met, their emissions."""
    sequences = sorted((s for s in sequences if len(s)), key=len, reverse=True)
    sizes = np.array([len(s) for s in sequences])
    width, length = len(sequences), int(sizes[0])
    ids = np.zeros((length, width), np.int64)
    for i, s in enumerate(sequences):
        ids[: len(s), i] = s
    live = [int(np.searchsorted(-sizes, -t, "left")) for t in range(length)]  # sequences longer than t
    states = len(model.start)
    step, emit = model.step.astype(np.float32), model.emit.astype(np.float32)
    alpha = np.empty((length, width, states), np.float32)
    scale = np.ones((length, width), np.float32)
    now = None
    for t in range(length):
        n = live[t]
        now = (model.start.astype(np.float32) if t == 0 else now[:n] @ step) * emit[ids[t, :n]]
        scale[t, :n] = now.sum(1)
        now /= scale[t, :n, None]
        alpha[t, :n] = now
    moved = np.zeros((states, states))
    beta = np.ones((live[-1], states), np.float32)
    for t in range(length - 1, 0, -1):
        n = live[t]
        if len(beta) < n:
            beta = np.concatenate([beta, np.ones((n - len(beta), states), np.float32)])
        ahead = emit[ids[t, :n]] * beta / scale[t, :n, None]
        moved += alpha[t - 1, :n].T @ ahead
        alpha[t, :n] *= beta
        beta = ahead @ step.T
    if len(beta) < width:
        beta = np.concatenate([beta, np.ones((width - len(beta), states), np.float32)])
    alpha[0] *= beta
    filled = np.arange(length)[:, None] < sizes[None, :]
    gamma, met = alpha[filled], ids[filled]
    emitted = np.stack([np.bincount(met, gamma[:, s], CLASSES) for s in range(states)], 1)
    rows = np.flatnonzero(emitted.any(1))
    return alpha[0].sum(0, dtype=np.float64), moved * model.step, rows, emitted[rows]


def _expect(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = len(shared.value.start)
        start, step, emit = np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES, states))
        for batch in batches_by_bytes(batches, "seq", 2 << 20):
            whole = [np.frombuffer(s, "<u2") for s in batch.column("seq").to_pylist()]
            pieces = [s[i : i + STRETCH] for s in whole for i in range(0, len(s), STRETCH)]
            for i in range(0, len(pieces), 1 << 13):
                a, b, rows, c = expected_counts(shared.value, pieces[i : i + (1 << 13)])
                start, step = start + a, step + b
                emit[rows] += c
        rows = np.flatnonzero(emit.any(1))
        every = np.concatenate([emit[rows], step, start[None, :]])
        # Emissions come under their class, steps under CLASSES + state, starts under CLASSES + states.
        slot = np.concatenate([rows, CLASSES + np.arange(states + 1)]).astype(np.int32)
        yield pa.record_batch({"slot": pa.array(slot), **{f"s{i}": pa.array(every[:, i]) for i in range(states)}})

    return run


def baum_welch(encoded: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Model trained on the sequences (`seq`) of all given rows.

    Each round sums the tasks' counts per class in Spark; what reaches the driver is
    CLASSES rows of a few numbers, whatever the size of the corpus.
    """
    spark = encoded.sparkSession
    model, shares = first_model(vocab, states), _corpus_shares(vocab)
    names = [f"s{i}" for i in range(states)]
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        counted = encoded.select("seq").mapInArrow(_expect(shared), "slot int, " + ", ".join(f"{n} double" for n in names))
        summed = counted.groupBy("slot").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        every = np.zeros((CLASSES + states + 1, states))
        every[summed["slot"].to_numpy()] = np.stack([summed[n].to_numpy() for n in names], 1)
        emit = every[:CLASSES] + PRIOR * shares[:, None]
        step, start = every[CLASSES:-1] + 1.0, every[-1] + 1.0
        model = Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))
        shared.unpersist()
    return model


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole sequence of classes, by the scaled forward recursion."""
    sizes = np.array([len(s) for s in sequences])
    order = np.argsort(-sizes, kind="stable")
    flat = np.concatenate(sequences).astype(np.int64)
    begin = (np.cumsum(sizes) - sizes)[order]
    ordered = sizes[order]
    total = np.zeros(len(sequences))
    now = None
    for t in range(int(ordered[0])):
        n = int(np.searchsorted(-ordered, -t, "left"))
        now = (model.start if t == 0 else now[:n] @ model.step) * model.emit[flat[begin[:n] + t]]
        mass = now.sum(1)
        now /= mass[:, None]
        total[:n] += np.log10(mass)
    out = np.empty(len(sequences))
    out[order] = total
    return out


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "seq", 8 << 20):
            found = log_likelihoods(shared.value, [np.frombuffer(s, "<u2") for s in batch.column("seq").to_pylist()])
            names = [n for n in batch.schema.names if n != "seq"]
            yield pa.record_batch({**{n: batch.column(n) for n in names}, "log_classes": pa.array(found)})

    return run


def hmm_scores(texts: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, text, held_out) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows with held_out are scored only, all others also train.  `base_score` is the add-one
    unigram log10 probability, `score` the model's.  Null and empty texts are one token, the
    end.  Repeated rows and null ids are rows of their own.  Without training rows every
    word is unknown: the base gives each probability 1.  An empty table gives an empty result.
    """
    spark = texts.sparkSession
    counts = stored(word_counts(texts.filter(~F.col("held_out")).select("doc_id", "text")), "word-counts")
    vocab = vocabulary(counts)
    known = spark.sparkContext.broadcast(vocab)
    encoded = stored(texts.select("doc_id", "text", "held_out").mapInArrow(_encode(known), _ENCODED), "encoded")
    model = spark.sparkContext.broadcast(baum_welch(encoded.filter(~F.col("held_out")), vocab, states, rounds))
    plain = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, log_within double"
    scored = encoded.drop("rare").mapInArrow(_score(model), plain + ", log_classes double")
    rare = encoded.select("key", F.explode("rare").alias("r")).select("key", F.col("r.word").alias("word"), F.col("r.n").alias("tf"))
    found = rare.join(counts, "word", "left").groupBy("key").agg(
        F.sum(F.when(F.col("n") > 0, F.col("tf")).otherwise(0)).alias("met"),
        F.sum(F.col("tf") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("log_rare"),
    )
    log_rare = F.coalesce("log_rare", F.lit(0.0))
    return scored.join(found, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + log_rare - F.col("n_tokens") * float(np.log10(vocab.tokens + vocab.distinct + 1.0))).alias("base_score"),
        (F.col("log_classes") + F.col("log_within") + log_rare).alias("score"),
    )


def with_held_out(docs: DataFrame, held_out: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Input of `hmm_scores`: `held_out` may use the columns doc_id and text."""
    return narrow(docs, id_col, text_col).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
