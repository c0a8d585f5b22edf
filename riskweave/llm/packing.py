"""Token sequences of fixed size filled by best-two-fit.

Texts become token ids inside the tasks, and only piece lengths travel on.  The
packing is planned over the histogram of lengths, which has at most as many rows
as a sequence has tokens however large the corpus is: a plan row is a filling of
a sequence and how many sequences get it.  Pieces then find their place by their
rank among the pieces of their length.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import batches_by_bytes, narrow, stored

#: Words, and pre-tokens, that a worker remembers before it starts anew; bounds its memory, not what it encodes.
REMEMBERED = 1_000_000


class WordEncoder:
    """Ids of whole texts by the `tokenizers` library, each distinct word encoded once.

    The tokenizer drops white space and never joins words across it, so the ids of a text
    are those of its words.  Words below U+0300, where its normaliser only lower-cases, are
    taken apart further at the tokenizer's own pre-token borders.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kinds = {c: unicodedata.category(c)[0] for c in map(chr, range(0x300))}
        letters = "".join(re.escape(c) for c, k in kinds.items() if k == "L")
        numbers = "".join(re.escape(c) for c, k in kinds.items() if k == "N")
        self.pretokens = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+").findall
        self.plain = re.compile("[\x00-\x1b\x20-\x84\x86-˿]*").fullmatch
        self.parts: dict[str, bytes] = {}
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.rows = _Numbered()
        self.flat, self.begin, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.filled = self.known = 0

    def release(self) -> None:
        """Frees the remembered words and pre-tokens."""
        self._forget()
        self.parts.clear()

    def _learn(self) -> None:
        """Encodes the words that turned up since the last call."""
        words, self.rows.fresh = self.rows.fresh, []
        if len(self.parts) > self.remembered:
            self.parts.clear()
        split, alone = [], []
        for word in words:
            simple = self.plain(word) and "<|" not in word
            split.append(self.pretokens(word.lower()) if simple else None)
            if not simple:
                alone.append(word)
        unseen = list({p for s in split if s for p in s if p not in self.parts})
        for piece, got in zip(unseen, self._encode(unseen), strict=True):
            self.parts[piece] = got
        whole = iter(self._encode(alone))
        ids = [next(whole) if s is None else b"".join([self.parts[p] for p in s]) for s in split]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        end, new = self.known + len(ids), int(sizes.sum())
        self.flat = _room(self.flat, self.filled + new)
        self.begin, self.size = _room(self.begin, end), _room(self.size, end)
        self.flat[self.filled : self.filled + new] = np.frombuffer(b"".join(ids), np.uint32)
        self.size[self.known : end] = sizes
        self.begin[self.known : end] = self.filled + np.cumsum(sizes) - sizes
        self.filled, self.known = self.filled + new, end

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as packed unsigned integers."""
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.rows) > self.remembered:
            self._forget()
        rows = []
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            rows.append(np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words)))
        if self.rows.fresh:
            self._learn()
        out = []
        for row in rows:
            sizes = self.size[row]
            ends = np.cumsum(sizes)
            out.append(self.flat[np.repeat(self.begin[row] - ends + sizes, sizes) + np.arange(ends[-1])])
        return out


class _Numbered(dict):
    """Numbers words in order of appearance."""

    def __init__(self):
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self.fresh.append(word)
        self[word] = number = len(self)
        return number


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    grown = np.zeros(max(size, 2 * len(array)), array.dtype)
    grown[: len(array)] = array
    return grown


@cache
def encoder(path: str, remembered: int = REMEMBERED) -> WordEncoder:
    """One encoder a worker process."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordEncoder(path, remembered)


_PIECES = "part int, rank long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(path: str, size: int, end_id: int, remembered: int, release: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from cut(batches)
        finally:
            if release:
                encoder(path, remembered).release()
                encoder.cache_clear()
                pa.default_memory_pool().release_unused()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path, remembered), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches_by_bytes(batches, "text", 4 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            row, piece, length, crc = [], [], [], []
            for at, ids in enumerate(encode(texts)):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, start in enumerate(range(0, len(ids), size)):
                    own = ids[start : start + size]
                    row.append(at)
                    piece.append(k)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
            rank = np.empty(len(row), np.int64)
            for i, n in enumerate(length):
                rank[i] = seen[n]
                seen[n] += 1
            pieces = np.array(piece, np.int32)
            yield pa.record_batch(
                {
                    "part": pa.array(np.full(len(row), part, np.int32)),
                    "rank": pa.array(rank),
                    "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                    "piece": pa.array(pieces),
                    "start": pa.array(pieces.astype(np.int64) * size),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )

    return run


def plan(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Fillings for pieces given as {length: number}: (sequences, [(length, copies)]).

    A sequence is filled greedily, longest piece that fits first.  Then its smallest piece
    gives way to the two unpacked pieces that fill the widened gap best, if they fill more.
    A filling is repeated while the pieces for it last.
    """
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    alive = [int(x) for x in np.flatnonzero(left)]
    fillings = []
    while alive:
        used: dict[int, int] = {}
        gap = size
        at = len(alive) - 1
        while at >= 0 and gap > 0:
            length = alive[at]
            take = min(gap // length, int(left[length]))
            if take:
                used[length] = take
                gap -= take * length
            at = min(at - 1, bisect_right(alive, gap) - 1)
        lengths = np.array(alive)
        while gap > 0:
            smallest = min(used)
            room = gap + smallest
            free = left[lengths].copy()
            for length, n in used.items():
                free[np.searchsorted(lengths, length)] -= n
            choice = lengths[(free > 0) & (lengths < room)]
            if not len(choice):
                break
            twice = free[np.searchsorted(lengths, choice)] > 1
            partner = np.searchsorted(choice, room - choice, "right") - 1
            partner = np.where((partner == np.arange(len(choice))) & ~twice, partner - 1, partner)
            sums = np.where(partner >= 0, choice + choice[np.maximum(partner, 0)], 0)
            best = int(sums.argmax())
            if sums[best] <= smallest:
                break
            used[smallest] -= 1
            if not used[smallest]:
                del used[smallest]
            for length in (int(choice[best]), int(choice[partner[best]])):
                used[length] = used.get(length, 0) + 1
            gap = room - int(sums[best])
        times = min(int(left[n]) // k for n, k in used.items())
        for length, k in used.items():
            left[length] -= times * k
        alive = [x for x in alive if left[x]]
        fillings.append((times, sorted(used.items(), reverse=True)))
    return fillings


def _places(fillings: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, np.ndarray]:
    """{length: rows of (first rank, copies in a sequence, first sequence, offset)} in order of rank."""
    rows: dict[int, list] = {}
    given: dict[int, int] = {}
    sequence = 0
    for times, used in fillings:
        offset = 0
        for length, k in used:
            rows.setdefault(length, []).append((given.get(length, 0), k, sequence, offset))
            given[length] = given.get(length, 0) + times * k
            offset += length * k
        sequence += times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def _assign(places: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("all_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                table = places[int(length[rows[0]])]
                first, copies, begin, at = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1].T
                nth = rank[rows] - first
                sequence[rows] = begin + nth // copies
                offset[rows] = at + nth % copies * length[rows]
            kept = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield pa.record_batch({**kept, "sequence_id": pa.array(sequence), "offset": pa.array(offset)})

    return run


def token_pieces(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED, release: bool = False) -> DataFrame:
    """Pieces of at most `size` ids of every document, its ids followed by `end_id`.

    Columns part, rank (among the pieces of one length in one partition), doc_id, piece,
    start, length, ids_crc32.  Null text counts as empty and gives one piece of length one.
    """
    return narrow(docs, id_col, text_col).mapInArrow(_cut(tokenizer, size, end_id, remembered, release), _PIECES)


def pack(pieces: DataFrame, size: int = 4096) -> DataFrame:
    """Pieces as from `token_pieces` with sequence_id and offset: sequences gapless from 0.

    Repeated rows are pieces of their own.  No pieces give no sequences.
    """
    pieces = stored(pieces, "pieces")
    counts = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = stored(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan(histogram, size))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["part", "length"]).withColumn("all_rank", F.col("rank") + F.col("before"))
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "all_rank").mapInArrow(_assign(places), columns)


def best_two_fit(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED, release: bool = False) -> DataFrame:
    """`docs` packed into as few sequences of `size` tokens as best-two-fit finds.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  Only
    documents longer than a sequence are cut.  `remembered` bounds the words that a worker keeps
    in memory, and with it the time, not the result.  Null and empty texts take one token; null ids
    and repeated rows are kept as rows of their own; an empty table gives an empty result.
    """
    return pack(token_pieces(docs, tokenizer, size, end_id, id_col, text_col, remembered, release), size)
