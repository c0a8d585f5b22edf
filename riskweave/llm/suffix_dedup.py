"""Removal of byte strings that occur earlier in the corpus: sampled prefix doubling.

Ranks of byte strings of length 1, 2, 4, ... are named by pairs of ranks at growing
offsets until they are past the threshold, as in prefix doubling over a suffix
array.  Ranks are hashes, so a pair is renamed in the task that holds the text, and
only what decides about uniqueness is shuffled and sorted.

Every string of threshold length belongs to the sampled suffix of least short rank
inside it, wherever the string occurs.  The strings of a suffix are neighbours and
lie in one context.  Round one: Spark sorts (short rank, context rank, position).
A short rank that is unique ends there.  Of equal contexts all but the first repeat.
Where a short rank has several contexts, texts agree around the suffix and part
further out: round two sorts these few contexts by short rank again, ranks each
string of threshold length in them, and keeps the first of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import NO_ID, batches_by_bytes, raw_texts, stored

#: Bytes of a short rank.
SHORT = 24
#: Bytes of texts ranked at once: a rank is eight bytes for each of them, and about ten such arrays live together.
SLICE = 1 << 20
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rank of each pair of ranks."""
    out = left * _ODD
    out ^= out >> np.uint64(31)
    out += right
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of the `length` bytes from each position of `data` that has so many, by doubling."""
    now, size, parts, done = _FIRST[data], 1, None, 0
    left = length
    while left:
        if left & 1:
            parts = now if parts is None else _pair(parts[: len(now) - done], now[done:])
            done += size
        left >>= 1
        if left:
            now, size = _pair(now[:-size], now[size:]), 2 * size
    return parts


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of `width` neighbours from each position on, by doubling."""
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    return values if size == width else np.minimum(values[: len(values) - width + size], values[width - size :])


def _suffixes(bodies: list[bytes], threshold: int) -> tuple[np.ndarray, ...]:
    """Sampled suffixes of texts: text number, first string, strings, suffix offset in the first, short and context rank.

    Texts shorter than the threshold have none.
    """
    sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
    long = np.flatnonzero(sizes >= threshold)
    if not len(long):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    joined = b"".join(bodies[i] for i in long)
    sizes = sizes[long]
    begin = np.cumsum(sizes) - sizes
    short = ranks(np.frombuffer(joined, np.uint8), SHORT)
    # The place in the low half makes the leftmost of equal short ranks the least.
    placed = (short & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(short), dtype=np.uint64)
    chosen = (_least(placed, threshold - SHORT + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    counts = sizes - threshold + 1
    text = np.repeat(np.arange(len(long)), counts)
    starts = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + begin[text]
    chosen = chosen[starts]
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    strings = np.diff(np.append(first, len(chosen)))
    at, owner, from_ = chosen[first], text[first], starts[first]
    offset = at - from_
    digest = xxhash.xxh3_64_intdigest
    ends = from_ + strings + threshold - 1
    context = np.array([digest(joined[s:e], o) for s, e, o in zip(from_.tolist(), ends.tolist(), offset.tolist(), strict=True)], np.uint64)
    return long[owner], from_ - begin[owner], strings, offset, short[at].view(np.int64), context.view(np.int64)


#: A place packs the first string's start, the suffix's offset in it and the number of strings.
def _place(start: np.ndarray, offset: np.ndarray, strings: np.ndarray) -> np.ndarray:
    return (start << 32) | (offset << 16) | strings


def _unplace(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 32, (place >> 16) & 0xFFFF, place & 0xFFFF


def _same_as_before(*columns: np.ndarray) -> np.ndarray:
    """Whether each row equals the row before it in all columns."""
    same = np.zeros(len(columns[0]), bool)
    if len(same):
        same[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return same


def _sampled(threshold: int):
    """(doc, tie, text) -> sampled suffixes.  What repeats inside a batch is settled there: it gets a key of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text", SLICE):
            text, start, strings, offset, short, context = _suffixes(raw_texts(batch.column("text")), threshold)
            doc, tie = (batch.column(c).to_numpy()[text] for c in ("doc", "tie"))
            place = _place(start, offset, strings)
            order = np.lexsort((place, tie, doc, context, short))
            short, context, doc, tie, place = (c[order] for c in (short, context, doc, tie, place))
            fresh = ~_same_as_before(short, context, doc, tie, place)
            settled = _same_as_before(short, context) & fresh
            short = np.where(settled, (doc.astype(np.uint64) * _ODD + place.astype(np.uint64)).view(np.int64), short)
            out = {"short": short, "context": context, "doc": doc, "tie": tie, "place": place, "settled": settled}
            yield pa.record_batch({n: pa.array(c[fresh]) for n, c in out.items()})

    return run


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes -> those to remove (open false) and those to look into (open true).

    Of the last short rank of a batch two rows are carried on: its first and its latest.
    """
    names = ("short", "context", "doc", "tie", "place")
    held = [np.zeros(0, np.int64)] * 5
    held_done = np.zeros(0, bool)
    for batch in batches:
        settled = batch.column("settled").to_numpy(zero_copy_only=False)
        own = [batch.column(n).to_numpy() for n in names]
        rows = [np.concatenate([h, c[~settled]]) for h, c in zip(held, own, strict=True)]
        short, context, doc, tie, place = rows
        done = np.concatenate([held_done, np.zeros(int((~settled).sum()), bool)])
        done |= _same_as_before(*rows)
        first = ~_same_as_before(short, context)
        rank_first = ~_same_as_before(short)
        group = np.cumsum(rank_first) - 1
        several = np.bincount(group[first], minlength=group[-1] + 1 if len(group) else 0) > 1
        several = several[group]
        repeat, open_ = ~first & ~done, first & several & ~done
        done |= open_
        for chosen, looked in ((repeat, False), (open_, True)):
            yield pa.record_batch({"short": pa.array(short[chosen]), "doc": pa.array(doc[chosen]), "tie": pa.array(tie[chosen]), "place": pa.array(place[chosen]), "open": pa.array(np.full(int(chosen.sum()), looked))})
        yield pa.record_batch({"short": pa.array(own[0][settled]), "doc": pa.array(own[2][settled]), "tie": pa.array(own[3][settled]), "place": pa.array(own[4][settled]), "open": pa.array(np.zeros(int(settled.sum()), bool))})
        if len(short):
            keep = np.unique([int(np.flatnonzero(rank_first)[-1]), len(short) - 1])
            held, held_done = [c[keep] for c in rows], done[keep]
            held_done[-1] |= len(keep) > 1


def _contexts(threshold: int):
    """Bodies with their open places -> the bytes of each context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            found = {n: [] for n in ("short", "doc", "tie", "place", "bytes")}
            docs, ties = batch.column("doc").to_pylist(), batch.column("tie").to_pylist()
            for i, body in enumerate(batch.column("body").to_pylist()):
                data, opened = unpack(body), batch.column("opened")[i].values
                place = opened.field("place").to_numpy()
                start, _, strings = _unplace(place)
                found["bytes"] += [data[s : s + n + threshold - 1] for s, n in zip(start.tolist(), strings.tolist(), strict=True)]
                found["short"].append(opened.field("short").to_numpy())
                found["place"].append(place)
                found["doc"].append(np.full(len(place), docs[i]))
                found["tie"].append(np.full(len(place), ties[i]))
            packed = {n: pa.array(np.concatenate(found[n]) if found[n] else np.zeros(0, np.int64)) for n in ("short", "doc", "tie", "place")}
            yield pa.record_batch({**packed, "bytes": pa.array(found["bytes"], pa.binary())})

    return run


def _strings(threshold: int):
    """Contexts sorted by short rank and position -> runs of strings (doc, tie, start, strings) that occur earlier."""

    def settle(batch: pa.RecordBatch, last: tuple[int, np.ndarray] | None):
        data, short = batch.column("bytes"), batch.column("short").to_numpy()
        start, offset, strings = _unplace(batch.column("place").to_numpy())
        sizes = strings + threshold - 1
        whole = ranks(np.frombuffer(b"".join(data.to_pylist()), np.uint8), threshold)
        row = np.repeat(np.arange(len(short)), strings)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
        key = whole[(np.cumsum(sizes) - sizes)[row] + nth]
        # Equal strings have their suffix in the same place.
        key = _pair(_pair(key, short[row].view(np.uint64)), (offset[row] - nth).view(np.uint64))
        order = np.argsort(key, kind="stable")
        later = np.zeros(len(key), bool)
        later[order[1:]] = key[order[1:]] == key[order[:-1]]
        if last is not None and short[0] == last[0]:
            mine = np.flatnonzero(short[row] == last[0])
            later[mine] |= np.isin(key[mine], last[1])
        tail = np.unique(key[short[row] == short[-1]])
        if last is not None and short[-1] == last[0]:
            tail = np.union1d(tail, last[1])
        at = np.flatnonzero(later)
        cut = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(row[at]) != 0)])) if len(at) else np.zeros(0, np.int64)
        runs = row[at[cut]]
        out = {"doc": batch.column("doc").to_numpy()[runs], "tie": batch.column("tie").to_numpy()[runs], "start": start[runs] + nth[at[cut]], "strings": np.diff(np.append(cut, len(at)))}
        return pa.record_batch({n: pa.array(c) for n, c in out.items()}), (int(short[-1]), tail)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches_by_bytes(batches, "bytes", SLICE):
            if batch.num_rows:
                found, last = settle(batch, last)
                yield found

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches_by_bytes(batches, "text", 8 << 20):
        body = pa.array([pack(t) for t in raw_texts(batch.column("text"))], pa.binary())
        yield pa.record_batch([*(batch.column(c) for c in ("doc", "tie", "copy", "rest")), body], names=["doc", "tie", "copy", "rest", "body"])


def cut_out(data: bytes, starts: np.ndarray, strings: np.ndarray, threshold: int) -> tuple[bytes, int, int]:
    """`data` without the bytes under strings of threshold length; bytes removed; maximal removed runs."""
    if not len(starts):
        return data, 0, 0
    steps = np.zeros(len(data) + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + strings - 1 + threshold, -1)
    gone = np.cumsum(steps[:-1]) > 0
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans


def _cut(threshold: int, readable: bool = False):
    """Bodies with their runs -> rest, numbers and the kept bytes; `readable`: rest and the kept bytes as text, parts of a cut character left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            kept, sizes, removed, spans = [], [], [], []
            for i, (body, copy) in enumerate(zip(batch.column("body").to_pylist(), batch.column("copy").to_pylist(), strict=True)):
                data, runs = unpack(body), batch.column("runs")[i].values
                if copy > 1 and len(data) >= threshold:
                    got = b"", len(data), 1
                elif runs is None:
                    got = data, 0, 0
                else:
                    got = cut_out(data, runs.field("start").to_numpy(), runs.field("strings").to_numpy(), threshold)
                sizes.append(len(data))
                for to, value in zip((kept, removed, spans), got, strict=True):
                    to.append(value)
            if readable:
                texts = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
                yield pa.record_batch([batch.column("rest"), texts], names=["rest", "text"])
                continue
            numbers = [pa.array(c, pa.int64()) for c in (sizes, removed, spans)]
            yield pa.record_batch([batch.column("rest"), *numbers, pa.array(kept, pa.binary())], names=["rest", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _marked(docs: DataFrame, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """Every row: rest (struct of its columns but the text), copy, packed body, runs of strings that occur earlier."""
    if threshold <= SHORT or threshold >= 1 << 15:
        raise ValueError(f"the threshold lies between {SHORT} and {1 << 15}")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc"))
    repeated = bool(ids.groupBy("doc").count().filter("count > 1").head(1))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    others = [F.col(c) for c in docs.columns if c != text_col]
    plain = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("doc"),
        (F.xxhash64(text) if repeated else F.lit(0).cast("long")).alias("tie"),
        F.struct(*others).alias("rest"),
        text.alias("text"),
    )
    columns = "short long, context long, doc long, tie long, place long"
    sampled = plain.select("doc", "tie", "text").mapInArrow(_sampled(threshold), f"{columns}, settled boolean")
    sorted_ = sampled.repartition(parts, "short").sortWithinPartitions("short", "context", "doc", "tie", "place")
    marks = stored(sorted_.mapInArrow(_classes, "short long, doc long, tie long, place long, open boolean"), "repeats")

    copy = F.row_number().over(Window.partitionBy("doc", "tie").orderBy("doc")) if repeated else F.lit(1)
    packed = f"doc long, tie long, copy int, rest {plain.schema['rest'].dataType.simpleString()}, body binary"
    bodies = plain.withColumn("copy", copy).mapInArrow(_pack, packed).repartition(parts, "doc", "tie")
    opened = marks.filter("open").groupBy("doc", "tie").agg(F.collect_list(F.struct("short", "place")).alias("opened"))
    joined = bodies.filter("copy = 1").join(opened, ["doc", "tie"]).select("doc", "tie", "body", "opened")
    contexts = joined.mapInArrow(_contexts(threshold), "short long, doc long, tie long, place long, bytes binary")
    around = contexts.repartition(parts, "short").sortWithinPartitions("short", "doc", "tie", "place")
    late = around.mapInArrow(_strings(threshold), "doc long, tie long, start long, strings long")

    early = marks.filter("not open").select("doc", "tie", F.shiftright("place", 32).alias("start"), F.expr("place & 65535").alias("strings"))
    runs = early.union(late).groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "strings")).alias("runs"))
    return bodies.join(runs, ["doc", "tie"], "left").select("copy", "rest", "body", "runs")


def remove_repeats(docs: DataFrame, threshold: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row: rest (struct of its columns but the text), n_bytes, n_removed, n_spans, kept (binary).

    Texts are UTF-8 bytes, null as empty.  A byte goes when it lies in a string of `threshold`
    bytes that also starts earlier: in a smaller id, or earlier in the same document; strings
    are judged on the input.  Null ids come first.  Rows that repeat an id are ordered by a
    hash of their text, rows that repeat both by chance: one of them stays, the others go
    whole if they reach the threshold.  Texts below the threshold stay as they are.
    """
    whole = _marked(docs, threshold, id_col, text_col)
    return whole.mapInArrow(_cut(threshold), f"rest {whole.schema['rest'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept binary")


def drop_repeats(docs: DataFrame, threshold: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with all its columns and the text without what `remove_repeats` removes; null becomes empty."""
    # One pass of Python: two in a row would keep two workers for every task, and their memory.
    whole = _marked(docs, threshold, id_col, text_col)
    texts = whole.mapInArrow(_cut(threshold, readable=True), f"rest {whole.schema['rest'].dataType.simpleString()}, text string")
    return texts.select(*[(F.col("text") if c == text_col else F.col("rest")[c]).alias(c) for c in docs.columns])
