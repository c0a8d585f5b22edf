"""Equi joins.  Sizes decide the strategy: no forced broadcasts here, adaptive
execution picks broadcast for a measured small side and splits skewed
partitions of sort-merge joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cleaning import dedup_keys
from .ordered import running_totals


def attach_identity(rows: DataFrame, identity: DataFrame, key: str, order: Sequence[str] | None = None) -> DataFrame:
    """Left join with the right side first reduced to one row per key."""
    return rows.join(dedup_keys(identity, [key], order), key, "left")


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of a batch whose key the target lacks; the first of a key in the batch wins."""
    return dedup_keys(batch, keys, order).join(target.select(*keys), list(keys), "left_anti")


def keep_known(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key exists on the other side."""
    return rows.join(other.select(key), key, "left_semi")


def customer_360(customers: DataFrame, sides: Sequence[DataFrame], key: str, zero: Sequence[str]) -> DataFrame:
    """Left joins of one-row-per-customer inputs; listed columns get 0 for null.

    Every side is aggregated on the key already, so all joins share one
    partitioning and the customer side is shuffled once.
    """
    out = customers
    for side in sides:
        out = out.join(side, key, "left")
    return out.fillna(0, subset=list(zero))


def dense_rank_category(df: DataFrame, column: str) -> DataFrame:
    """Distinct category values with their ascending dense rank, found by ranges
    of equal first characters: no task sees all values."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    starts = [F.substring(F.col(column).cast("string"), 1, n) for n in (1, 3, 8)]
    ranked = running_totals(values, {"rank": F.lit(1).cast("bigint")}, starts, [F.col(column)])
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def lookup_by_rank(
    df: DataFrame, column: str, table: Mapping[int, str], default: str, name: str = "value"
) -> DataFrame:
    """Categories with the entry at ``(rank - 1) mod n + 1`` of a small fixed table."""
    entries = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    slot = (F.col("rank") - 1) % len(table) + 1
    return dense_rank_category(df, column).select(
        column, "rank", F.coalesce(F.try_element_at(entries, slot.cast("int")), F.lit(default)).alias(name)
    )
