"""Ordered bands over numeric columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import as_col

# Band edges and labels of the reports.
TENURE_EDGES = (-1, 6, 12, 24, 48, 999)
TENURE_LABELS = ("0-6 months", "6-12 months", "12-24 months", "24-48 months", "48+ months")
RATE_EDGES = (-1, 7, 14, 100)
RATE_LABELS = ("low", "medium", "high")
DTI_EDGES = (-1, 10, 20, 30, 1000)
DTI_LABELS = ("<10", "10-20", "20-30", "30+")
FICO_EDGES = (0, 600, 660, 700, 740, 900)
FICO_LABELS = ("<600", "600-659", "660-699", "700-739", "740+")
AMOUNT_EDGES = (0, 25, 100, 250, 500, 1000, 1_000_000_000)
AMOUNT_LABELS = ("<25", "25-100", "100-250", "250-500", "500-1k", "1k+")


def bucketize(c: Column | str, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """Label of the interval a value falls in; outside every interval is null.

    ``right=True`` closes intervals on the right: ``(edge[i], edge[i+1]]``.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    col = as_col(c)
    low, high = F.lit(edges[0]), F.lit(edges[-1])
    inside = (col > low) & (col <= high) if right else (col >= low) & (col < high)
    chain = None
    for edge, label in zip(edges[1:], labels):
        below = col <= F.lit(edge) if right else col < F.lit(edge)
        chain = F.when(below, F.lit(label)) if chain is None else chain.when(below, F.lit(label))
    return F.when(inside, chain)


def tenure_group(c: Column | str) -> Column:
    return bucketize(c, TENURE_EDGES, TENURE_LABELS)


def rate_bucket(c: Column | str) -> Column:
    """Interest rate in percent."""
    return bucketize(c, RATE_EDGES, RATE_LABELS)


def dti_bucket(c: Column | str) -> Column:
    return bucketize(c, DTI_EDGES, DTI_LABELS)


def fico_band(c: Column | str) -> Column:
    return bucketize(c, FICO_EDGES, FICO_LABELS)


def amount_band(c: Column | str) -> Column:
    return bucketize(c, AMOUNT_EDGES, AMOUNT_LABELS)


def label_order(c: Column | str, labels: Sequence[str], default: int = 99) -> Column:
    """1-based position of an ordered label, for sorting."""
    position = F.array_position(F.array(*[F.lit(x) for x in labels]), as_col(c))
    return F.coalesce(F.nullif(position, F.lit(0).cast("bigint")), F.lit(default).cast("bigint")).cast("int")
