import random

import pytest
from pyspark.sql import functions as F


def _text(rng, words):
    letters = "abcdefghijklmnop é"
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))).strip() or "x" for _ in range(words))


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text) with nulls, empties, copies, near copies, shared passages and very long texts."""
    rng = random.Random(3)
    base = [_text(rng, rng.randint(20, 120)) for _ in range(25)]
    passage = _text(rng, 60)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 4]) for i in range(12)]
    rows += [(200 + i, base[i].upper()) for i in range(3)]
    for i in range(10):
        words = base[i].split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((300 + i, " ".join(words)))
    rows += [(400 + i, f"{_text(rng, 15)}\n{passage}\n{_text(rng, 15)}") for i in range(8)]
    rows += [(500, None), (501, ""), (502, ""), (503, " \n\t "), (504, "\n\n"), (505, "one"), (506, "two words"), (507, "é" * 150), (508, "a" * 400), (509, "ab" * 300)]
    rows += [(600, _text(rng, 4000)), (601, (passage + " ") * 20)]
    return rows


@pytest.fixture(scope="session")
def odd_corpus(corpus):
    """The same with repeated ids, repeated rows and null ids."""
    return corpus + [(1, corpus[2][1]), (1, corpus[3][1]), (5, corpus[5][1]), (5, corpus[5][1]), (None, corpus[6][1]), (None, None)]


@pytest.fixture(scope="session")
def documents(spark):
    """Frame of rows, with more columns under names that operators use themselves."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
        clashing = ("doc", "tie", "row", "copy", "component", "node", "keep", "fp", "part", "rank", "piece", "length", "short", "rest", "lines", "score", "held_out", "label")
        return df.select("*", *[F.lit("x").alias(c) for c in clashing])

    return make


class Links:
    """Union-find of the brute-force answers."""

    def __init__(self, nodes):
        self.up = {n: n for n in nodes}

    def find(self, n):
        while self.up[n] != n:
            self.up[n] = self.up[self.up[n]]
            n = self.up[n]
        return n

    def link(self, a, b):
        self.up[self.find(a)] = self.find(b)


@pytest.fixture(scope="session")
def links():
    return Links
