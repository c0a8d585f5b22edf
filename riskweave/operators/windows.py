"""Latest-value windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], ts: str, id_: str) -> DataFrame:
    """The newest row per key.  The rank filter also runs before the shuffle, so
    a busy key sends one row per task."""
    newest = Window.partitionBy(*keys).orderBy(F.col(ts).desc(), F.col(id_).desc())
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def latest_bucket(df: DataFrame, bucket: str, values: Sequence[str]) -> DataFrame:
    """Values of the newest bucket, as one row."""
    newest = F.max(F.struct(bucket, *values)).alias("m")
    return df.agg(newest).select("m.*")
