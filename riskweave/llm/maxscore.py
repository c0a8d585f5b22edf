"""Exact top-k by MaxScore over vector components.

A component is a term, a candidate's value in it the posting.  A query's bound on a
term is the most that the term can add over its least contribution in a shard; the
terms of smallest bounds whose sum stays under the threshold are non-essential.
Essential postings are traversed, the others are probed, largest bound first, only
for candidates that can still reach the threshold.  Each shard yields its best k
per query, and shards are merged.

Inner products are exact.  Vectors whose products 64 bits hold are scored in 64-bit integers;
a query or candidate with a larger component goes the same way in Python integers.

Candidates are dealt to shards by a hash of their id and queries go to all shards
in blocks, so a task holds one shard and one block of bounded size.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Candidates of a shard and queries of a block, about.
SHARD, BLOCK = 8_192, 2_048
#: Candidates scored in full to start the threshold; terms probed between two comparisons with it.
START, PROBE = 64, 8
#: Most digits of a score that is compared exactly between shards.
DIGITS = 38


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, values) of the vectors that take part: scale * x of each component x, not yet floored.

    Vectors that are null or hold null or non-finite components, and rows without id, are
    left out.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    values = F.transform("v", lambda x: x * scale)
    return rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine).select("vec_id", values.alias("values"))


def _matrix(lists: pd.Series, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Floors of the rows as doubles, shorter vectors ending in zeros, and which rows fit 64-bit products."""
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    np.floor(out, out=out)
    return out, np.abs(out).max(1) <= np.sqrt(2.0**60 / width)


def _integers(floors: np.ndarray, fit: bool) -> np.ndarray:
    if fit:
        return floors.astype(np.int64)
    exact = np.empty(floors.shape, object)
    exact.flat = [int(x) for x in floors.flat]
    return exact


def shard_top(ids: np.ndarray, matrix: np.ndarray, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of a query's best k in one shard, ids ascending within a score.

    `ids` ascend.  Rows of the query's own id are no candidates.  Numbers are 64-bit or,
    as objects, Python integers.
    """
    others = ids != query_id
    low = np.where(query >= 0, query * matrix.min(0), query * matrix.max(0))
    high = np.where(query >= 0, query * matrix.max(0), query * matrix.min(0))
    bounds = high - low
    order = np.argsort(-bounds, kind="stable")
    left = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)  # most that terms from here on can add
    base = int(low.sum())
    first = np.flatnonzero(others[: START + 1])[:START]
    threshold = None
    if len(first) >= k:
        threshold = _kth(matrix[first] @ query, k)
    # Terms are essential up to the first place from where all others together stay under the threshold.
    essential = len(order) if threshold is None else int(np.searchsorted(-(base + left), -threshold, "right"))
    essential = min(max(essential, 1), len(order))
    lists = order[:essential]
    alive = np.flatnonzero(others)
    sums = (matrix[:, lists] @ query[lists])[alive] + (base - int(low[lists].sum()))
    at = essential
    while at < len(order) and len(alive):
        if threshold is not None:
            stay = sums + left[at] >= threshold
            alive, sums = alive[stay], sums[stay]
        terms = order[at : at + PROBE]
        sums = sums + matrix[np.ix_(alive, terms)] @ query[terms] - int(low[terms].sum())
        at += PROBE
        if len(sums) >= k:  # sums are lower bounds of scores
            now = _kth(sums, k)
            threshold = now if threshold is None else max(threshold, now)
    best = np.argsort(-sums, kind="stable")[:k]  # alive ascends
    return ids[alive[best]], sums[best]


def _kth(scores: np.ndarray, k: int):
    """The k-th largest."""
    return np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, -k)[-k]


_FOUND = f"query_id long, vec_id long, score long, wide decimal({DIGITS},0)"


def _row(query_id: int, vec: np.ndarray, scores: np.ndarray) -> pd.DataFrame:
    """Scores that no long holds are null and stand in `wide`, ended at its digits."""
    if scores.dtype != object:
        return pd.DataFrame({"query_id": query_id, "vec_id": vec, "score": scores, "wide": None})
    fits, most = [-(2**63) <= x < 2**63 for x in scores], 10**DIGITS - 1
    short = pd.array([x if f else None for x, f in zip(scores, fits)], "Int64")
    wide = [None if f else Decimal(max(min(x, most), -most)) for x, f in zip(scores, fits)]
    return pd.DataFrame({"query_id": query_id, "vec_id": vec, "score": short, "wide": pd.Series(wide, dtype=object)})


def _search(k: int):
    def run(keys: tuple, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(candidates) and len(queries):
            width = max(candidates["values"].map(len).max(), queries["values"].map(len).max(), 1)
            candidates = candidates.sort_values("vec_id", kind="stable")
            ids, (floors, small) = candidates["vec_id"].to_numpy(), _matrix(candidates["values"], width)
            asked, short = _matrix(queries["values"], width)
            usual, outliers = _integers(floors[small], True), _integers(floors[~small], False)
            whole = _integers(floors[small], False) if not short.all() and small.any() else None
            for query_id, floor, fit in zip(queries["query_id"], asked, short, strict=True):
                if small.any():
                    found.append(_row(query_id, *shard_top(ids[small], usual if fit else whole, query_id, _integers(floor, fit), k)))
                if not small.all():
                    found.append(_row(query_id, *shard_top(ids[~small], outliers, query_id, _integers(floor, False), k)))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "wide": []})

    return run


def top_k(vectors: DataFrame, is_query: F.Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k highest integer inner products.

    Queries are the rows for which `is_query` (on vec_id) holds; candidates all rows of other
    ids.  Ties go to the smaller vec_id; fewer candidates give fewer rows.  Vectors of unequal
    length compare as if the shorter ended in zeros.  Rows that repeat an id are one candidate
    each; a query id that repeats searches once, with its greatest vector.  A score that no
    long holds is null, but takes its place by its value (up to 38 digits).
    """
    usable = quantised(vectors, id_col, vec_col, scale)
    queries = usable.filter(is_query).groupBy("vec_id").agg(F.max("values").alias("values"))
    sizes = usable.agg(F.count("*"), F.count_if(is_query)).first()
    shards, blocks = -(-sizes[0] // SHARD) or 1, -(-sizes[1] // BLOCK) or 1
    block = F.pmod(F.xxhash64(F.col("vec_id"), F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    shard = F.pmod(F.xxhash64("vec_id", "values"), F.lit(shards)).cast("int").alias("shard")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    here = usable.select("vec_id", "values", shard, every_block)
    asked = queries.select(F.col("vec_id").alias("query_id"), "values", block, every_shard)
    grouped = here.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
    found = grouped.applyInPandas(_search(k), _FOUND)
    value = F.coalesce("wide", F.col("score").cast(f"decimal({DIGITS},0)"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(value.desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
