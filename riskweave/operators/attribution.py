"""What each feature adds to a tree model's answer: path-dependent Shapley values of rows.

A tree answers for a set of known features by following the row where it knows the
feature and both ways, by their shares of training rows, where it does not.  For one leaf
this is a product over the features of its path, so the average over all orders of
learning the features is a sum over set sizes: the product of (share + fits * t) over the path's
features as a polynomial in t, with one factor divided out a feature.  A row enters it only by which
of the path's features it fits, so short paths are worked out once for every such set and rows
look their set up.  All rows of a batch are worked at once; node tables are sent with the tasks and grow with the model only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from .boosting import HistogramBoostingModel, trees_of

#: Rows that are worked at once.
SLICE = 2048
#: Features of a path up to which all sets of them are worked out at once, and leaves whose sets a task remembers (3 KB each).
TABLE_FEATURES, TABLES = 6, 10_000


@dataclass
class Nodes:
    """A tree as arrays by node number; node 0 is the root."""

    feature: np.ndarray  # -1 at leaves
    threshold: np.ndarray  # values up to it go left
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # what a leaf adds to the answer
    share: np.ndarray  # training rows that came here
    lefts: dict[int, frozenset[float]]  # categories that go left, where a split has categories

    def goes_left(self, node: int, x: np.ndarray) -> np.ndarray:
        column = x[:, self.feature[node]]
        if node in self.lefts:
            return np.isin(column, list(self.lefts[node]))
        return np.where(np.isnan(column), self.missing_left[node], column <= self.threshold[node])

    def expected(self, node: int = 0) -> float:
        if self.feature[node] < 0:
            return float(self.value[node])
        children = (self.left[node], self.right[node])
        return sum(self.share[c] / self.share[node] * self.expected(c) for c in children)


@dataclass
class TreeModel:
    """Margin = base + the trees' leaves."""

    base: float
    trees: list[Nodes]

    def expected(self) -> float:
        return self.base + sum(t.expected() for t in self.trees)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += _leaves(t, x, 0, np.ones(len(x), bool))
        return out


def _leaves(t: Nodes, x: np.ndarray, node: int, here: np.ndarray) -> np.ndarray:
    if t.feature[node] < 0:
        return here * t.value[node]
    left = t.goes_left(node, x)
    return _leaves(t, x, t.left[node], here & left) + _leaves(t, x, t.right[node], here & ~left)


def _add_leaf(out: np.ndarray, value: float, path: dict[int, tuple[float, np.ndarray]], tables: dict[tuple[int, int], np.ndarray] | None = None, leaf: tuple[int, int] = (0, 0)) -> None:
    d = len(path)
    if not d or not value:
        return
    n = len(out)
    if tables is not None and d <= TABLE_FEATURES:
        table = tables.get(leaf)
        if table is None:
            sets = np.arange(2**d)
            table = np.zeros((2**d, d))
            _add_leaf(table, value, {i: (share, sets >> i & 1 == 1) for i, (share, _) in enumerate(path.values())})
            if len(tables) < TABLES:
                tables[leaf] = table
        at = np.zeros(n, np.intp)
        for i, (_, fits) in enumerate(path.values()):
            at |= fits.astype(np.intp) << i
        for i, feature in enumerate(path):
            out[:, feature] += table[at, i]
        return
    poly = np.zeros((d + 1, n))  # coefficient by set size
    poly[0] = 1.0
    for k, (share, fits) in enumerate(path.values()):
        for s in range(k + 1, 0, -1):
            poly[s] = poly[s] * share + poly[s - 1] * fits
        poly[0] *= share
    weights = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
    for feature, (share, fits) in path.items():
        # poly / (share + t) where the row fits, poly / share where it does not
        total, carry = np.zeros(n), np.zeros(n)
        for s in range(d - 1, -1, -1):
            carry = np.where(fits, poly[s + 1] - share * carry if s < d - 1 else poly[s + 1], 0.0)
            total += weights[s] * np.where(fits, carry, poly[s] / share)
        out[:, feature] += value * total * (fits - share)


def shapley(model: TreeModel, x: np.ndarray, tables: dict[tuple[int, int], np.ndarray] | None = None) -> np.ndarray:
    """Contribution of every feature to every row; with `expected` they add up to the margin.

    `tables`, empty at first, remembers the model's leaves (tree, node) from batch to batch.
    """
    out = np.zeros(x.shape[::-1]).T  # a feature's rows lie together
    tables = {} if tables is None else tables

    def walk(tree: int, t: Nodes, node: int, path: dict[int, tuple[float, np.ndarray]]) -> None:
        f = int(t.feature[node])
        if f < 0:
            _add_leaf(out, float(t.value[node]), path, tables, (tree, node))
            return
        left = t.goes_left(node, x)
        share, fits = path.get(f, (1.0, np.ones(len(x), bool)))
        for child, way in ((t.left[node], left), (t.right[node], ~left)):
            walk(tree, t, int(child), {**path, f: (share * t.share[child] / t.share[node], fits & way)})

    for tree, t in enumerate(model.trees):
        walk(tree, t, 0, {})
    return np.ascontiguousarray(out)


# ---------------------------------------------------------------- models


def _from_boosting(stage: HistogramBoostingModel) -> TreeModel:
    model = stage.model
    edges, trees = [np.array([*e, np.inf]) for e in model["edges"]], []
    for t in trees_of(model):
        # heap numbers start at 1: node i of the arrays is heap number i + 1
        at = np.arange(1, len(t.feature))
        feature = t.feature[at]
        threshold = np.array([edges[f][b] if f >= 0 else 0.0 for f, b in zip(feature, t.bin[at], strict=True)])
        trees.append(Nodes(feature, threshold, t.missing_left[at], 2 * at - 1, 2 * at, t.value[at], t.rows[at], {}))
    return TreeModel(model["base"], trees)


def _from_spark(stage, spark: SparkSession) -> TreeModel:
    """Spark ML's forests and boosted trees, from the node table that they save."""
    path = work_dir(spark, "tree-model")
    stage.write().save(path)
    table = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()  # nodes of the model
    boosted = hasattr(stage, "treeWeights") and "GBT" in type(stage).__name__
    weights = stage.treeWeights if boosted else [1.0 / stage.getNumTrees] * stage.getNumTrees
    by_tree: dict[int, list] = {}
    for r in table:
        by_tree.setdefault(r["treeID"], []).append(r)
    trees = []
    for tree, weight in enumerate(weights):
        rows = by_tree[tree]
        n = len(rows)
        feature, threshold = np.full(n, -1), np.zeros(n)
        left, right, value, share, lefts = np.zeros(n, int), np.zeros(n, int), np.zeros(n), np.zeros(n), {}
        for i, r in enumerate(rows):
            stats = r["impurityStats"]
            share[i] = r["rawCount"]
            value[i] = weight * (r["prediction"] if boosted else stats[1] / (sum(stats) or 1.0))
            if r["leftChild"] >= 0:
                split = r["split"]
                feature[i], left[i], right[i] = split["featureIndex"], r["leftChild"], r["rightChild"]
                if split["numCategories"] >= 0:
                    lefts[i] = frozenset(split["leftCategoriesOrThreshold"])
                else:
                    threshold[i] = split["leftCategoriesOrThreshold"][0]
        trees.append(Nodes(feature, threshold, np.zeros(n, bool), left, right, value, share, lefts))
    return TreeModel(0.0, trees)


def tree_model(stage, spark: SparkSession) -> TreeModel:
    """Node arrays of a fitted tree classifier.  The margin is the log-odds of histogram boosting, half the log-odds
    of Spark's boosted trees, and the probability of a forest."""
    return _from_boosting(stage) if isinstance(stage, HistogramBoostingModel) else _from_spark(stage, spark)


def contributions(model: TreeModel, rows: DataFrame, id_: str, vector: str) -> DataFrame:
    """`id, contributions array<double>` of rows (id, vector array<double>)."""
    held = rows.select(id_, F.col(vector).cast("array<double>").alias("_v"))
    schema = held.select(id_, F.col("_v").alias("contributions")).schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[tuple[int, int], np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                x = batch.column("_v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                yield pa.record_batch({id_: batch.column(id_), "contributions": pa.array(list(shapley(model, x, tables)), pa.list_(pa.float64()))})

    return held.mapInArrow(step, schema)


def explain_trees(model: PipelineModel, df: DataFrame, names: list[str], id_: str) -> DataFrame:
    """Contribution of every encoded feature of a tree pipeline to every row: `id, feature, contribution`.

    With the expected margin of the model (`tree_model(...).expected()`) they add up to the row's margin.
    """
    # dealt out, as the work of a row is far more than reading it
    prepared = PipelineModel(stages=model.stages[:-1]).transform(df.repartition(id_)).select(id_, vector_to_array("features").alias("v"))
    found = contributions(tree_model(model.stages[-1], df.sparkSession), prepared, id_, "v")
    cells = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("feature"), F.col("contributions").alias("contribution"))
    return found.select(id_, F.explode(cells).alias("c")).select(id_, "c.feature", "c.contribution")
