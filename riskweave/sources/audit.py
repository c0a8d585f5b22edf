"""Load audit: what was read, written and rejected, measured during the write."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .schemas import AUDIT
from .writers import write_table


def audited_write(
    df: DataFrame,
    target: str,
    audit_path: str,
    *,
    dag: str,
    task: str,
    source: str,
    bad: Column | None = None,
    mode: str = "overwrite",
) -> DataFrame:
    """Write the good rows and append one audit row; returns that row.

    Counts are collected by the write itself (``observe``), so the input is
    read once.  A failed write is audited with its error and raised again.
    """
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    spark = df.sparkSession
    flag = F.lit(False) if bad is None else F.coalesce(bad, F.lit(False))
    # The observation lives in a session of its own: fitted models that still hold
    # their training summary cannot be sent to tasks from a session with observers.
    view = f"audited_{uuid.uuid4().hex}"
    df.withColumn("_bad", flag).createGlobalTempView(view)
    seen = Observation()
    observed = spark.newSession().table(f"global_temp.{view}").observe(
        seen, F.count(F.lit(1)).alias("read"), F.count_if("_bad").alias("failed")
    )
    status, error, read, failed = "SUCCESS", None, None, None
    problem: Exception | None = None
    try:
        write_table(observed.where(~F.col("_bad")).drop("_bad"), target, mode)
        read, failed = seen.get["read"], seen.get["failed"]
    except Exception as exc:  # the audit row must exist for failed loads too
        status, error, problem = "FAILED", str(exc), exc
    finally:
        spark.catalog.dropGlobalTempView(view)
    done = datetime.now(timezone.utc).replace(tzinfo=None)
    written = None if read is None else read - failed
    row = spark.createDataFrame(
        [(dag, task, source, target, read, written, failed, status, started, done, error)], AUDIT
    )
    write_table(row, audit_path, "append")
    if problem is not None:
        raise problem
    return row


def reconcile_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, as one list."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out
