"""Exact k-means over integer vectors with Shallot search.

A vector remembers its centroid, the second-nearest of its last search, an upper bound
of its distance to the first and a lower bound of that to all others.  Centroids move;
the bounds follow by the triangle inequality, and a vector whose upper bound stays under
its lower bound, or under half the gap from its centroid to the next, keeps its cluster
unread.  The others are searched: from the closer one of the two remembered centroids,
through the others in ascending distance from it, inside a ball that shrinks with every
better second.  Bounds are floating-point numbers rounded outwards and only rule
centroids out; the survivors are compared by squared distances in integers.

Vectors and bounds are one table, mapped once a round and kept by Spark (`persist`).  Its
lineage holds narrow steps only, so what a lost executor held is computed again from its
own input rows.  Centroid sums follow the vectors that moved, added up in each task
before their shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import stored

#: Relative error granted to every floating-point step of a bound; far above 2^-53.
SLACK = 1e-12
LONGEST = 2**63 - 1
#: Sums travel as digits of this base, so that none is too large for a column.
BASE = 2**62


def integers(raw: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x): 64-bit where squared distances of such numbers fit, else Python integers."""
    floors = np.floor(raw.astype(np.float64) * scale)
    most = np.sqrt(2.0**62 / max(raw.shape[1], 1)) / 2 if raw.ndim == 2 else 0.0
    if not floors.size or np.abs(floors).max() < most:
        return floors.astype(np.int64)
    return np.array([int(v) for v in floors.ravel()], object).reshape(floors.shape)


def _matrix(column: pa.Array, scale: float) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return integers(flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1)), scale)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to rows, or to one centroid."""
    gap = x - c if x.dtype == c.dtype else x.astype(object) - c.astype(object)
    return (gap * gap).sum(axis=1)


def _root(exact: np.ndarray, sign: int) -> np.ndarray:
    """Square roots, rounded up (sign 1) or down (-1)."""
    if exact.dtype != object:
        return np.sqrt(exact.astype(np.float64)) * (1 + sign * SLACK)
    most = np.finfo(np.float64).max
    whole = [isqrt(v) + (sign > 0) for v in exact.ravel().tolist()]
    found = [float(v) * (1 + sign * SLACK) if v < most else (np.inf if sign > 0 else most) for v in whole]
    return np.array(found).reshape(exact.shape)


class Centroids:
    """Centroids of a round with the distances between them and to those of the round before."""

    def __init__(self, values: list[list[int]], before: list[list[int]] | None = None):
        big = max((abs(v) for c in values for v in c), default=0)
        self.c = np.array(values, object)
        if big < np.sqrt(2.0**62 / max(len(values[0]), 1)) / 2:
            self.c = self.c.astype(np.int64)
        k = len(values)
        gaps = np.array([squared(self.c, one) for one in self.c]).reshape(k, k)
        self.between = _root(gaps, -1)
        others = [[j for j in range(k) if j != i] for i in range(k)]
        self.order = [sorted(others[i], key=lambda j, i=i: (gaps[i, j], j)) for i in range(k)]
        self.half = np.array([self.between[i, o].min() / 2 * (1 - SLACK) if o else np.inf for i, o in enumerate(others)])
        self.moved = np.zeros(k) if before is None else _root(squared(self.c, np.array(before, object)), 1)
        self.others_moved = np.array([self.moved[o].max() if o else 0.0 for o in others])

    def search(self, x: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """Nearest and second-nearest centroid of each row and their squared distances.

        `a` and `b` are the remembered two; ties go to the smaller number.
        """
        da, db = squared(x, self.c[a]), squared(x, self.c[b])
        swap = (db < da) | ((db == da) & (b < a))
        first, other = np.where(swap, b, a), np.where(swap, a, b)
        second, start = other.copy(), first.copy()
        d1, d2 = np.where(swap, db, da), np.where(swap, da, db)
        reach = _root(d1, 1)
        for p in np.unique(start):
            rows = np.flatnonzero(start == p)
            for j in self.order[p]:
                # neighbours only get farther and the ball smaller: who is out stays out
                rows = rows[self.between[p, j] <= (reach[rows] + _root(d2[rows], 1)) * (1 + SLACK)]
                if not len(rows):
                    break
                todo = rows[other[rows] != j]
                dj = squared(x[todo], self.c[j])
                nearer = (dj < d1[todo]) | ((dj == d1[todo]) & (j < first[todo]))
                won, placed = todo[nearer], todo[~nearer & (dj < d2[todo])]
                d2[won], second[won] = d1[won], first[won]
                d1[won], first[won] = dj[nearer], j
                d2[placed], second[placed] = dj[~nearer & (dj < d2[todo])], j
        return first, second, d1, d2

    def assign(self, x: np.ndarray, cluster: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, ...]:
        """Clusters, seconds and bounds after the centroids have moved here."""
        cluster, second = cluster.copy(), second.copy()
        upper = (upper + self.moved[cluster]) * (1 + SLACK)
        lower = lower - self.others_moved[cluster]
        lower -= np.abs(lower) * SLACK

        def unsure(rows: np.ndarray) -> np.ndarray:
            return rows[~(upper[rows] < np.maximum(lower[rows], self.half[cluster[rows]]))]

        rows = unsure(np.arange(len(x)))
        if len(rows):
            upper[rows] = _root(squared(x[rows], self.c[cluster[rows]]), 1)
            rows = unsure(rows)
        if len(rows):
            cluster[rows], second[rows], d1, d2 = self.search(x[rows], cluster[rows], second[rows])
            upper[rows], lower[rows] = _root(d1, 1), _root(d2, -1)
        return cluster, second, upper, lower


def _rounds(centroids: Centroids, scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            was = batch.column("cluster").to_numpy()
            state = [was, *(batch.column(c).to_numpy() for c in ("second", "upper", "lower"))]
            cluster, second, upper, lower = centroids.assign(_matrix(batch.column("embedding"), scale), *state)
            yield pa.record_batch({
                "vec_id": batch.column("vec_id"), "embedding": batch.column("embedding"), "cluster": cluster.astype(np.int32),
                "second": second.astype(np.int32), "previous": was, "upper": upper, "lower": lower,
            })

    return step


def digits(value: int) -> list[int]:
    """Base-2^62 digits, the least first, each with the sign of the value; none for zero."""
    sign, rest, out = (-1 if value < 0 else 1), abs(value), []
    while rest:
        rest, digit = divmod(rest, BASE)
        out.append(sign * digit)
    return out


def _moves(k: int, scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: what joined less what left each cluster, as count and component sums."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = [0] * k, [0] * k
        for batch in batches:
            x = _matrix(batch.column("embedding"), scale)
            for name, sign in (("cluster", 1), ("previous", -1)):
                at = batch.column(name).to_numpy()
                for j in np.unique(at[at >= 0]):
                    rows = x[at == j]
                    sums[j] = sums[j] + sign * rows.sum(axis=0).astype(object)
                    counts[j] += sign * len(rows)
        held = [j for j in range(k) if not isinstance(sums[j], int)]
        if held:
            yield pa.record_batch({
                "cluster": pa.array(held, pa.int32()), "n": pa.array([counts[j] for j in held], pa.int64()),
                "sums": pa.array([[digits(v) for v in sums[j]] for j in held], pa.list_(pa.list_(pa.int64()))),
            })

    return step


def _distances(centroids: Centroids, scale: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster = batch.column("cluster").to_numpy()
                found = squared(_matrix(batch.column("embedding"), scale), centroids.c[cluster]).tolist()
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id"), "cluster": batch.column("cluster"),
                    "distance": pa.array([v if v <= LONGEST else None for v in found], pa.int64()),
                })

    return step


def usable(vectors: DataFrame, scale: float, components: int, id_col: str, vec_col: str) -> DataFrame:
    """Ids and vectors of `components` finite components; a component too large to be scaled counts as infinite."""
    kind = vectors.schema[vec_col].dataType.elementType.typeName()
    held = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(f"array<{kind if kind == 'float' else 'double'}>").alias("embedding"))
    limit = F.lit(float("inf"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v.cast("double") * F.lit(float(scale))) < limit))
    return held.where(F.col("embedding").isNotNull() & (F.size("embedding") == components) & finite)


def shallot_clusters(
    vectors: DataFrame, k: int = 8, rounds: int = 10, scale: float = 1024.0, components: int = 64, seed: str = "3",
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """Exact Lloyd clustering: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid.

    Components are floor(scale * x).  The first centroids are the `k` vectors whose ids have
    the smallest sha256 of `seed:id`.  A round assigns every vector to the nearest centroid
    (ties: smaller number) and replaces every non-empty centroid by the floor of its
    vectors' mean; vectors are assigned once more after the last.  `centroid` holds the
    final components, joined by commas.

    Vectors that are null, of another length or hold null or non-finite components take no
    part.  A null id counts as the empty text where ids are hashed; repeated rows are
    vectors of their own, and the smaller vector comes first where ids tie.  Fewer than `k`
    vectors make fewer centroids, an empty table an empty result.  A distance or sum that
    no 64-bit integer holds is null; clusters are exact all the same.  Rounds stop early
    once no centroid moves, since later ones would change nothing.
    """
    held = usable(vectors, scale, components, id_col, vec_col)
    spark = vectors.sparkSession
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = held.orderBy(digest, "vec_id", "embedding").limit(k).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid string")
    now = integers(np.array([r["embedding"] for r in first], np.float64), scale).tolist()
    k = len(now)
    start = F.lit(0)
    state = held.select(
        "vec_id", "embedding", start.alias("cluster"), F.lit(min(1, k - 1)).alias("second"), F.lit(-1).alias("previous"),
        F.lit(float("inf")).alias("upper"), F.lit(float("-inf")).alias("lower"),
    )
    schema, before, totals, counts, kept = state.schema, None, [[0] * components for _ in range(k)], [0] * k, []
    fresh = True
    for _ in range(rounds):
        if fresh:  # nobody belongs to a cluster yet: all are joined to their first one below
            state, fresh = state.mapInArrow(_rounds(Centroids(now), scale), schema).withColumn("previous", F.lit(-1)), False
        else:
            state = state.mapInArrow(_rounds(Centroids(now, before), scale), schema)
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(state)
        moved = state.where("cluster <> previous").select("embedding", "cluster", "previous")
        parts = moved.mapInArrow(_moves(k, scale), "cluster int, n long, sums array<array<long>>")
        cells = parts.select("cluster", "n", F.posexplode("sums").alias("pos", "digits")).select("cluster", "n", "pos", F.posexplode_outer("digits").alias("digit", "v"))
        change = cells.groupBy("cluster", "pos", "digit").agg(
            F.sum(F.when(F.coalesce("digit", F.lit(0)) == 0, F.col("n"))).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")
        )
        for r in change.collect():  # a row for each digit of k times `components` sums
            totals[r["cluster"]][r["pos"]] += int(r["s"] or 0) * BASE ** (r["digit"] or 0)
            counts[r["cluster"]] += (r["n"] or 0) if r["pos"] == 0 else 0
        for old in kept[:-1]:
            old.unpersist()
        kept = kept[-1:]
        before, now = now, [[s // n for s in t] if n else c for t, n, c in zip(totals, counts, now, strict=True)]
        if before == now:
            break
    last = Centroids(now, before)
    state = state.mapInArrow(_rounds(last, scale), schema)
    final = stored(state.mapInArrow(_distances(last, scale), "vec_id long, cluster int, distance long"), "clusters")
    for old in kept:
        old.unpersist()
    whole = F.count("distance") == F.count(F.lit(1))
    sums = final.groupBy("cluster").agg(F.when(whole, F.sum(F.col("distance").cast("decimal(38,0)"))).alias("s")).collect()
    inertia = {r["cluster"]: None if r["s"] is None else int(r["s"]) for r in sums}
    everything = None if None in inertia.values() else sum(inertia.values())

    def as_long(v: int | None) -> F.Column:
        return F.lit(v if v is not None and v <= LONGEST else None).cast("long")

    by_cluster = F.array(*[as_long(inertia.get(j, 0)) for j in range(k)])
    texts = F.array(*[F.lit(",".join(map(str, c))) for c in now])
    return final.select(
        "vec_id", "cluster", "distance", by_cluster[F.col("cluster")].alias("cluster_inertia"), as_long(everything).alias("inertia"),
        texts[F.col("cluster")].alias("centroid"),
    )
