"""Exact deduplication by content sort.

Splitters sampled by Spark's range partitioner deal out the normalised texts by
(first bytes, digest, id); each partition is sorted externally, which puts equal
texts next to each other, and neighbours are compared byte by byte.  The id is
part of the sort key, so a text with very many copies spreads over many
partitions; runs cut by a partition border are merged from two short records a
partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import id_array, ids_to_arrow, narrow, raw_texts, stored

#: Bytes of a text that take part in the range splitters; keeps sampled keys short.
HEAD = 64
_SORTABLE = "doc_id long, head binary, digest binary, body binary"
_RUNS = "part int, doc_id long, digest binary, n long, keep long, keeper boolean, edge boolean"


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        body = [text.lower() for text in raw_texts(batch.column("text"))]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "head": pa.array([b[:HEAD] for b in body], pa.binary()),
                "digest": pa.array([hashlib.sha256(b).digest() for b in body], pa.binary()),
                "body": pa.array(body, pa.binary()),
            }
        )


def _runs(largest: bool):
    """Runs of equal neighbours of one sorted partition, one row a document."""

    def rows(part: int, digest: bytes, ids: list[np.ndarray], edge: bool) -> pa.RecordBatch:
        every = np.concatenate(ids)
        at = len(every) - 1 if largest else 0
        size = len(every)
        return pa.record_batch(
            {
                "part": pa.array(np.full(size, part, np.int32)),
                "doc_id": ids_to_arrow(every),
                "digest": pa.array([digest] * size, pa.binary()),
                "n": pa.array(np.full(size, size, np.int64)),
                "keep": ids_to_arrow(np.full(size, every[at])),
                "keeper": pa.array(np.arange(size) == at),
                "edge": pa.array(np.full(size, edge)),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, held, first, out = None, [], True, []
        for batch in batches:
            if not batch.num_rows:
                continue
            digest, body, ids = batch.column("digest"), batch.column("body"), id_array(batch.column("doc_id"))
            same = pc.and_(pc.equal(digest.slice(1), digest.slice(0, len(digest) - 1)), pc.equal(body.slice(1), body.slice(0, len(body) - 1)))
            begins = np.flatnonzero(np.concatenate([[True], ~same.to_numpy(zero_copy_only=False).astype(bool)]))
            for start, end in zip(begins, [*begins[1:], len(ids)], strict=True):
                now = (digest[start].as_py(), body[start].as_py()) if start == 0 or end == len(ids) else None
                if start == 0 and last is not None and now == last:
                    held.append(ids[start:end])
                    continue
                if held:
                    out.append(rows(part, last_digest, held, first))
                    first = False
                last_digest, held, last = digest[start].as_py(), [ids[start:end]], now
            if len(out) >= 256:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
                out = []
        if held:
            out.append(rows(part, last_digest, held, True))
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()

    return run


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, digest (SHA-256 of the normalised text).

    Texts are equal when their bytes are, after lower-casing A-Z.  `keep` says whether
    the smallest or the largest id of a group stays.  Null text counts as empty; a null
    id counts as the smallest.  Of rows that repeat both id and text exactly one is kept.
    An empty table gives an empty result; other columns are ignored.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    largest = keep == "largest"
    order = ("head", "digest", "doc_id")
    sortable = narrow(docs, id_col, text_col).mapInArrow(_normalise, _SORTABLE)
    dealt = sortable.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = stored(dealt.mapInArrow(_runs(largest), _RUNS), "content-runs")
    # Of a run that crosses partition borders each partition adds one record; at most two a partition are edges.
    pick = F.max if largest else F.min
    cut = (
        runs.filter("edge and keeper")
        .groupBy("digest")
        .agg(F.sum("n").alias("all_n"), pick(F.struct("keep", "part")).alias("best"), F.count("*").alias("parts"))
        .filter("parts > 1")
        .drop("parts")
    )
    joined = runs.join(F.broadcast(cut), "digest", "left")
    whole = F.col("best").isNull()
    return joined.select(
        "doc_id",
        F.when(whole, F.col("keep")).otherwise(F.col("best.keep")).alias("keep_id"),
        F.coalesce("all_n", "n").alias("group_size"),
        (F.col("keeper") & (whole | (F.col("part") == F.col("best.part")))).alias("kept"),
        "digest",
    )
