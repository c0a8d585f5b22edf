"""Hashed word and character n-gram features, and bounded samples of labelled texts."""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Callable
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import narrow

#: Hash buckets of words and n-grams.
BUCKETS = 1 << 18
#: Shortest and longest character n-gram; `<` and `>` mark the ends of a word.
SHORTEST, LONGEST = 3, 5
#: Words whose score a worker remembers before it starts anew.
REMEMBERED = 150_000


def bucket_list(word: bytes) -> list[int]:
    """Buckets of a word (UTF-8): its own first, then those of its character n-grams."""
    marked = f"<{word.decode('utf-8', 'replace')}>".encode("utf-32-le")  # four bytes a character
    end = len(marked)
    grams = [crc32(marked[i : i + n]) % BUCKETS for n in range(4 * SHORTEST, 4 * LONGEST + 1, 4) for i in range(0, end - n + 1, 4)]
    return [crc32(b"w " + word) % BUCKETS, *grams]


def word_buckets(word: bytes) -> np.ndarray:
    return np.array(bucket_list(word), np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Callable[[str], F.Column], rows: int, id_col: str = "doc_id", text_col: str = "text") -> list[tuple[bytes, int]]:
    """At most `rows` labelled texts, those whose ids hash smallest: the same at any partitioning.

    `usable` says by the id column which rows may be learned from.  Rows without id or label
    are left out; of repeated labels the largest counts, of repeated documents each text once.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & usable("doc_id"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(*order).limit(rows)
    found = narrow(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "text"])
    taken = found.orderBy(*order, "text").limit(rows).select(F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("text"), "label").toArrow()
    return list(zip(taken["text"].to_pylist(), taken["label"].to_pylist(), strict=True))


class Featuriser:
    """Texts as sparse averages over their words; a word is the average of its buckets."""

    def __init__(self):
        self.words: dict[bytes, np.ndarray] = {}

    def word(self, word: bytes) -> np.ndarray:
        if (found := self.words.get(word)) is None:
            found = self.words[word] = word_buckets(word)
        return found

    def text(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Distinct buckets and their weights, which add up to one."""
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        counts = Counter(words)
        lists = [self.word(w) for w in counts]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        share = np.fromiter(counts.values(), np.float64, len(lists)) / len(words)
        ids, place = np.unique(np.concatenate(lists), return_inverse=True)
        return ids, np.bincount(place, np.repeat(share / sizes, sizes))


class Vocabulary:
    """Numbers of words and their buckets in a few arrays, which are given back to the system whole."""

    def __init__(self):
        self.names: list[bytes] = []
        self._numbers: dict[bytes, int] = {}
        self._flat, self._size = array("i"), array("i")

    def number(self, word: bytes) -> int:
        if (found := self._numbers.get(word)) is None:
            found = self._numbers[word] = len(self.names)
            self.names.append(word)
            buckets = bucket_list(word)
            self._flat.extend(buckets)
            self._size.append(len(buckets))
        return found

    def counted(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the distinct words, in order of appearance, and how often each appears."""
        counts = Counter(words)
        return np.fromiter(map(self.number, counts), np.int32, len(counts)), np.fromiter(counts.values(), np.int32, len(counts))

    def freeze(self) -> None:
        """No word is added from here on; buckets can be read."""
        self.flat, self.size = np.frombuffer(self._flat, np.int32), np.frombuffer(self._size, np.int32)
        self.begin = np.cumsum(self.size, dtype=np.int64) - self.size

    def buckets(self, number: int) -> np.ndarray:
        return self.flat[self.begin[number] : self.begin[number] + self.size[number]]

    def together(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of words, one after the other, and where those of each begin."""
        sizes = self.size[numbers].astype(np.int64)
        begins = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.begin[numbers] - begins, sizes) + np.arange(sizes.sum())], begins


class WordScores(dict):
    """Score of a word under a linear model over buckets, remembered."""

    def __init__(self, table: np.ndarray):
        self.table = table.tolist()

    def __missing__(self, word: bytes) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        buckets = bucket_list(word)
        self[word] = score = sum(map(self.table.__getitem__, buckets)) / len(buckets)
        return score


def logistic(x: float) -> float:
    return 1 / (1 + np.exp(-min(max(x, -500.0), 500.0)))
