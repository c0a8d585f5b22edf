"""Writers.  File tables by default; any Spark format by name."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "append",
    fmt: str = "parquet",
    partition_by: str | None = None,
    partitions: int | None = None,
    **options: str,
) -> None:
    """Write in one pass; nothing is counted before or after.

    ``partitions`` bounds the number of JDBC connections or output files."""
    if partitions and fmt == "jdbc":
        df = df.coalesce(partitions)
    writer = df.write.mode(mode).format(fmt).options(**options)
    if fmt == "jdbc":
        writer.option("dbtable", target).option("batchsize", options.get("batchsize", "5000")).save()
        return
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(target)


def replace_partitions(df: DataFrame, target: str, partition_by: str, fmt: str = "parquet") -> None:
    """Overwrite exactly the partitions present in ``df``: a rerun of a day
    replaces that day and leaves the others alone.

    Rows are rebalanced by the partition column first: not every task writes
    every day, and a day that holds most rows is still written by many tasks.
    """
    (
        df.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .format(fmt)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .save(target)
    )
