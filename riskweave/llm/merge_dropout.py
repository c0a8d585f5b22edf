"""SentencePiece BPE with seeded merge-dropout, and its decoding.

Pieces are merged best score first, leftmost first among equals; each candidate merge is
skipped when a keyed hash of seed, document, place of the word, place and piece of the
candidate falls under the dropout rate.  So every occurrence of a word draws for itself.
A candidate's draw depends on nothing else, so it is taken when the candidate comes up: one
that is skipped is none.  All parts of words of a batch of texts merge side by side, in each
round the best candidate of each.  Rate zero gives the model's own segmentation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from heapq import heapify
from heapq import heappop as pop
from heapq import heappush as push

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from riskweave.llm.common import batches_by_bytes, id_array, runs

#: The mark that pieces carry for a space.
SPACE = "▁"
#: Characters of a part from which it is merged by itself, off an agenda.
LONG = 48
#: No candidate; a character that was merged into the one before it; a character of no piece.
_NONE, _GONE, _UNKNOWN = np.int32(np.iinfo(np.int32).max), -1, -2


class Pieces:
    """The pieces of a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bytes = [0] * 256
        self.text: list[bytes] = []
        self.ids: dict[str, int] = {}
        ranked = []
        for i, name in enumerate(names):
            if model.is_byte(i):
                self.bytes[int(name[1:-1], 16)] = i
                self.text.append(bytes([int(name[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                self.ids[name] = i
                ranked.append((-model.get_score(i), i))
                self.text.append(name.replace(SPACE, " ").encode())
        # Pieces of one score keep one rank: then the place decides, as in the model.
        order = {s: r for r, s in enumerate(sorted({s for s, _ in ranked}))}
        self.rank = {names[i]: order[s] << 48 for s, i in ranked}
        #: Characters that stand side by side in some piece; no merge crosses any other border.
        self.pairs = {name[i : i + 2] for name in self.ids for i in range(len(name) - 1)}
        self._tables()

    def _tables(self) -> None:
        """The same for arrays.  Symbols are ids of pieces; characters of pieces that are none themselves follow."""
        symbols = dict(self.ids)
        for c in sorted({c for name in self.ids for c in name}):
            symbols.setdefault(c, len(self.text) + len(symbols) - len(self.ids))
        #: Symbols of characters; a space stands for the mark, a mark of the text for itself as bytes.
        self.symbol = np.full(0x110000, _UNKNOWN, np.int32)
        singles = [(ord(c), n) for c, n in symbols.items() if len(c) == 1 and c not in (SPACE, " ")]
        self.symbol[[c for c, _ in singles]] = [n for _, n in singles]
        self.symbol[ord(" ")] = symbols.get(SPACE, _UNKNOWN)
        classes = {c: n for n, c in enumerate(sorted({c for pair in self.pairs for c in pair}), 1)}
        self.kind = np.zeros(0x110000, np.int32)
        self.kind[[ord(c) for c in classes]] = list(classes.values())
        self.kind[[ord(" "), ord(SPACE)]] = classes.get(SPACE, 0), 0
        #: Whether characters of two kinds stand side by side in a piece.
        self.beside = np.zeros((len(classes) + 1, len(classes) + 1), bool)
        for x, y in self.pairs:
            self.beside[classes[x], classes[y]] = True
        self.order = np.zeros(len(self.text), np.int32)
        self.order[list(self.ids.values())] = [self.rank[name] >> 48 for name in self.ids]
        found = [(symbols[x], symbols[y], n) for name, n in self.ids.items() for i in range(1, len(name)) if (x := name[:i]) in symbols and (y := name[i:]) in symbols]
        left, right, made = np.array(found, np.int64).reshape(-1, 3).T
        keys = left << 32 | right
        # Open addressing: a key stands in the first free slot from its own on.
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.keys, self.made = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        slot = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            self.keys[slot[placed]], self.made[slot[placed]] = keys[placed], made[placed]
            rest = np.ones(len(keys), bool)
            rest[placed] = False
            keys, made, slot = keys[rest], made[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)
        self.byte = np.array(self.bytes, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(_M1)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Pieces that pairs of symbols make, -1 where none."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.made[slot], np.int32(-1))
        more = np.flatnonzero((there != keys) & (there >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[more]]
            same = there == keys[more]
            out[more[same]] = self.made[slot[more[same]]]
            more = more[~same & (there >= 0)]
        return out


_PLACE = (1 << 24) - 1
_WORD = (1 << 64) - 1
_M1, _M2, _M3 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _mixed(x: np.ndarray) -> np.ndarray:
    """Hash of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_M2)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_M3)
    return x ^ (x >> np.uint64(31))


def _draws(keys: np.ndarray, tops: np.ndarray) -> np.ndarray:
    """24 bits that an occurrence of this key draws for a candidate, as `segment` does."""
    x = (keys ^ tops) * np.uint64(_M2)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(_M3)) >> np.uint64(40)


def segment(unit: str, pieces: Pieces, limit: int, key: int, path: list[tuple[int, bool]] | None = None) -> list[int]:
    """Ids of a part of a word; `key` names seed, document and place, `limit` is the rate in 2^-24.

    `path` gets the candidates in turn and whether they were skipped.
    """
    size = _merged(unit, pieces, limit, key, path)
    out: list[int] = []
    i = 0
    while i < len(unit):
        symbol = unit[i : i + size[i]]
        if (known := pieces.ids.get(symbol)) is not None:
            out.append(known)
        else:
            out.extend(pieces.bytes[b] for b in symbol.encode())
        i += size[i]
    return out


def _merged(unit: str, pieces: Pieces, limit: int, key: int, path: list[tuple[int, bool]] | None = None) -> list[int]:
    """Lengths of the symbols of a part at their first characters, 0 at all others.

    An agenda entry packs rank, start and length of a candidate; one whose symbols were
    merged otherwise meanwhile no longer adds up to its length.  A skipped candidate does not
    come back: its characters are never again two symbols, cut elsewhere.
    """
    end = len(unit)
    rank, size, before = pieces.rank, [1] * end, list(range(-1, end - 1))
    agenda = []
    for i in range(end - 1):
        if (r := rank.get(unit[i : i + 2])) is not None:
            agenda.append(r | i << 24 | 2)
    heapify(agenda)
    while agenda:
        top = pop(agenda)
        length, i = top & _PLACE, top >> 24 & _PLACE
        left = size[i]
        j = i + left
        if not left or j >= end or left + size[j] != length:
            continue
        if limit:
            x = (key ^ top) * _M2 & _WORD
            skipped = ((x ^ x >> 32) * _M3 & _WORD) >> 40 < limit
            if path is not None:
                path.append((top, skipped))
            if skipped:
                continue
        size[i], size[j] = length, 0
        k, h = i + length, before[i]
        if k < end:
            before[k] = i
            if (r := rank.get(unit[i : k + size[k]])) is not None:
                push(agenda, r | i << 24 | length + size[k])
        if h >= 0 and (r := rank.get(unit[h:k])) is not None:
            push(agenda, r | h << 24 | k - h)
    return size


class DropoutEncoder:
    def __init__(self, path: str, rate: float, seed: int):
        self.pieces, self.limit, self.seed = Pieces(path), int(rate * 2.0**24), seed

    def _candidates(self, left: np.ndarray, right: np.ndarray, start: np.ndarray, length: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces that pairs make, and their rank and place in one number; none where there is no piece or it is skipped."""
        made = self.pieces.joined(left, right)
        found = np.flatnonzero(made >= 0)
        rank, start = self.pieces.order[made[found]], start[found]
        if self.limit:
            tops = rank.astype(np.uint64) << np.uint64(48) | start.astype(np.uint64) << np.uint64(24) | length[found].astype(np.uint64)
            kept = _draws(keys[found], tops) >= np.uint64(self.limit)
            found, rank, start = found[kept], rank[kept], start[kept]
        best = np.full(len(made), _NONE)
        best[found] = rank << 6 | start
        return made, best

    def _merge(self, begin: np.ndarray, size: np.ndarray, keys: np.ndarray, symbols: np.ndarray, made: np.ndarray, best: np.ndarray) -> None:
        """Merges the symbols of parts of at most LONG characters that begin here; `best` is what `_candidates` says of each character and the next."""
        width = int(size.max())
        place = np.arange(width - 1)[:, None]
        inside = place < size - 1
        order = np.where(inside, best[np.where(inside, begin + place, begin)], _NONE)
        length, before = np.ones(len(symbols), np.int8), np.arange(-1, len(symbols) - 1)
        part = np.arange(len(begin))
        while True:
            least = order.min(axis=0)
            live = np.flatnonzero(least != _NONE)
            if not len(live):
                return
            if 4 * len(live) < 3 * len(part):
                order, part, least, live = np.ascontiguousarray(order[:, live]), part[live], least[live], np.arange(len(live))
            own = part[live]
            first, i = begin[own], (least[live] & 63).astype(np.int64)
            at = first + i
            j = i + length[at]
            k = j + length[first + j]
            symbols[at], symbols[first + j], length[at] = made[at], _GONE, k - i
            order[i, live] = _NONE
            order[np.minimum(j, width - 2), live] = np.where(j < width - 1, _NONE, order[width - 2, live])
            after, ahead = np.flatnonzero(k < size[own]), np.flatnonzero(i > 0)
            before[first[after] + k[after]] = at[after]
            h = before[at[ahead]]
            left, right = np.concatenate([at[after], h]), np.concatenate([first[after] + k[after], at[ahead]])
            column = np.concatenate([live[after], live[ahead]])
            start = left - begin[part[column]]
            pieces, found = self._candidates(symbols[left], symbols[right], start, right - left + length[right], keys[part[column]])
            made[left] = pieces
            order[start, column] = found

    def encode(self, texts: list[str], documents: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts, one after the other, and their numbers; documents and places key the draws.  An empty text has none.

        A text follows a space.  A word begins at a space that follows none; between its
        characters that are side by side in no piece it falls into parts.
        """
        pieces = self.pieces
        chars = np.array([len(t) + 1 if t else 0 for t in texts], np.int64)
        whole = "".join([" " + t for t in texts if t])
        if not whole:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        codes = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        text_at = np.cumsum(chars) - chars
        blank = codes == 32
        word_here = blank.copy()
        word_here[1:] &= ~blank[:-1]
        word_here[text_at[chars > 0]] = True
        kind = pieces.kind[codes]
        border = np.append(word_here, True)
        border[1:-1] |= ~pieces.beside[kind[:-1], kind[1:]]
        begin = np.flatnonzero(border[:-1])
        size = np.diff(np.append(begin, len(codes)))
        many = np.flatnonzero(size > 1)
        begin, size = begin[many], size[many]
        # Keys of the words, then of their parts.
        word = np.cumsum(word_here) - 1
        word_at = np.flatnonzero(word_here)
        starts = np.array([xxhash.xxh64_intdigest(b"%d" % d, self.seed) for d in documents], np.uint64)
        document = np.searchsorted(text_at + chars, word_at, "right")
        place = np.arange(len(word_at)) - word[text_at[document]]
        keys = _mixed(starts[document] + place.astype(np.uint64) * np.uint64(_M1))
        own = word[begin]
        keys = keys[own] + (begin - word_at[own]).astype(np.uint64) * np.uint64(_M1)
        symbols = pieces.symbol[codes]
        made, best = np.full(len(codes), -1, np.int32), np.full(len(codes), _NONE)
        short = np.flatnonzero(size <= LONG)
        count = size[short] - 1
        at = _spread(begin[short], count)
        made[at], best[at] = self._candidates(symbols[at], symbols[at + 1], at - np.repeat(begin[short], count), np.full(len(at), 2), np.repeat(keys[short], count))
        widths = (2, 3, 4, 5, 6, 7, 8, 10, 12, 16, 24, LONG)
        for narrow, wide in zip((1, *widths), widths, strict=False):
            if len(here := short[(size[short] > narrow) & (size[short] <= wide)]):
                self._merge(begin[here], size[here], keys[here], symbols, made, best)
        for n in np.flatnonzero(size > LONG).tolist():
            b, unit = int(begin[n]), whole[begin[n] : begin[n] + size[n]].replace(" ", SPACE)
            for i, length in enumerate(_merged(unit, pieces, self.limit, int(keys[n]))):
                if length != 1:
                    symbols[b + i] = pieces.ids[unit[i : i + length]] if length else _GONE
        # A character that is no piece becomes its bytes.
        raw = np.flatnonzero((symbols == _UNKNOWN) | (symbols >= len(pieces.text)))
        copies = (symbols != _GONE).astype(np.int64)
        marked = np.where(codes[raw] == 32, np.uint32(ord(SPACE)), codes[raw])
        copies[raw] = 1 + (marked > 0x7F) + (marked > 0x7FF) + (marked > 0xFFFF)
        ends = np.concatenate([[0], np.cumsum(copies)])
        ids = np.repeat(symbols, copies)
        ids[_spread(ends[raw], copies[raw])] = pieces.byte[np.frombuffer(marked.tobytes().decode("utf-32-le").encode(), np.uint8)]
        return ids, ends[text_at + chars] - ends[text_at]

    def __call__(self, text: str, document: int) -> np.ndarray:
        """Ids of one text."""
        return self.encode([text], [document])[0]


def _spread(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs of these begins and sizes."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


@cache
def encoder(path: str, rate: float, seed: int) -> DropoutEncoder:
    """One encoder a worker process and setting."""
    return DropoutEncoder(path, rate, seed)


@cache
def piece_texts(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces, one after the other, and where each begins and the last ends."""
    texts = Pieces(path).text
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])


def encode(docs: DataFrame, model: str, rate: float = 0.1, seed: int = 17, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text (null as empty) and ids (array of int) of every row.

    The same seed, id and text give the same ids on any partitioning; rows with null id share
    one key.  An empty table gives an empty result; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = encoder(model, rate, seed)
        for batch in batches_by_bytes(batches, "text", 1 << 18):
            texts = batch.column("text").to_pylist()
            flat, sizes = encoded.encode(texts, id_array(batch.column("doc_id")).tolist())
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "text": batch.column("text"), "ids": ids})

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(run, "doc_id long, text string, ids array<int>")


def decode_ids(ids: np.ndarray, sizes: np.ndarray, texts: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """Texts of runs of ids of these numbers: pieces joined, without the space that encoding puts in front."""
    flat, begins = texts
    lengths = begins[ids + 1] - begins[ids]
    whole = flat[_spread(begins[ids], lengths)]
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
    some = ends[1:] > ends[:-1]
    rest = np.ones(len(whole), bool)
    rest[ends[:-1][some]] = False
    offsets = np.concatenate([[0], np.cumsum(np.diff(ends) - some)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(whole[rest])]).cast(pa.string())


def decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """`encoded` with a column `decoded`; null ids count as none and decode to the empty text."""
    place = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = piece_texts(model)
        for batch in batches:
            sizes = batch.column(place).value_lengths().fill_null(0).to_numpy()
            for start, end in runs(sizes, 1 << 17):
                part = batch.slice(start, end - start)
                found = decode_ids(part.column(place).flatten().to_numpy(), sizes[start:end], texts)
                yield pa.record_batch([*part.columns, found], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", StringType())]))
