"""Decode, de-duplicate, window and flag a stream of transaction messages.

The functions take and return DataFrames and work on batch and streaming
input alike unless they say otherwise; ``start_*`` helpers attach sinks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import dedup_keys
from ..operators.measures import stream_measures
from ..sources.committed import append_committed, is_committed, read_committed
from ..sources.schemas import CORRUPT, MESSAGE

# Flush interval and window lengths of the monitoring views.
TRIGGER = "5 seconds"
MINUTE, SHORT, LONG = "1 minute", "5 minutes", "2 hours"
REQUIRED = ("transaction_id", "account_id", "amount", "merchant", "category", "city", "is_fraud", "timestamp")
NOT_NULL = ("transaction_id", "account_id", "amount", "merchant", "category", "timestamp")


def decode(messages: DataFrame) -> DataFrame:
    """Parse the JSON payload; ``ok`` is false where it is malformed or lacks a key."""
    wide = T.StructType([*MESSAGE.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = messages.select("data", F.from_json("data", wide, options).alias("m"))
    keys = F.json_object_keys("data")
    has_keys = F.coalesce(F.size(F.array_except(F.array(*[F.lit(k) for k in REQUIRED]), keys)) == 0, F.lit(False))
    filled = F.lit(True)
    for c in NOT_NULL:
        filled = filled & F.col(f"m.{c}").isNotNull()
    ok = F.col("m").isNotNull() & F.col(f"m.{CORRUPT}").isNull() & has_keys & filled
    return parsed.select(
        "data",
        *[F.col(f"m.{c}").alias(c) for c in ("transaction_id", "account_id", "amount", "merchant", "category", "city")],
        (F.col("m.is_fraud") != 0).alias("is_fraud"),
        F.col("m.timestamp").alias("transaction_ts"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
    )


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.where("ok").drop("data", "ok")


def rejected(decoded: DataFrame) -> DataFrame:
    """Raw text of the skipped messages, for a dead-letter sink."""
    return decoded.where(~F.col("ok")).select("data")


def once_within(txns: DataFrame, delay: str) -> DataFrame:
    """First message per transaction id, with state bounded by the watermark."""
    return txns.withWatermark("transaction_ts", delay).dropDuplicatesWithinWatermark(["transaction_id"])


def counters(txns: DataFrame) -> DataFrame:
    """Running totals of rows and fraud rows (``complete`` or ``update`` mode)."""
    return txns.agg(F.count(F.lit(1)).alias("ingested"), F.count_if("is_fraud").alias("fraud_detected"))


def _window_measures() -> list:
    cents = "decimal(38,2)"
    average = F.round(F.try_divide(F.sum("amount").cast("decimal(28,6)"), F.count("amount")), 2)
    return [
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if("is_fraud").alias("fraud_count"),
        average.cast(cents).alias("avg_amount"),
        F.sum("amount").cast(cents).alias("total_amount"),
    ]


def tumbling_minute(txns: DataFrame, now: str | None = None, delay: str | None = None) -> DataFrame:
    """Per-minute totals.  With ``now``: the two hours up to it, both edges
    included, newest first (batch).  With ``delay``: a watermarked stream."""
    if delay:
        txns = txns.withWatermark("transaction_ts", delay)
    if now:
        end = F.lit(now).cast("timestamp")
        txns = txns.where(F.col("transaction_ts").between(end - F.expr(f"interval {LONG}"), end))
    out = txns.groupBy(F.window("transaction_ts", MINUTE)).agg(*_window_measures())
    out = out.select(F.col("window.start").alias("minute_bucket"), "total_transactions", "fraud_count", "avg_amount", "total_amount")
    return out.orderBy(F.col("minute_bucket").desc()) if now else out


def rolling_5min(txns: DataFrame, now: str) -> DataFrame:
    """One row: the five minutes up to ``now``, both edges included (batch)."""
    end = F.lit(now).cast("timestamp")
    recent = txns.where(F.col("transaction_ts").between(end - F.expr(f"interval {SHORT}"), end))
    average = F.round(F.try_divide(F.sum("amount").cast("decimal(28,6)"), F.count("amount")), 2).cast("decimal(38,2)")
    return recent.agg(
        F.count(F.lit(1)).alias("transactions_last_5min"), F.count_if("is_fraud").alias("fraud_last_5min"),
        average.alias("avg_amount_5min"),
    ).select(end.alias("window_end"), "*")


def sliding_5min(txns: DataFrame, delay: str | None = None) -> DataFrame:
    """The rolling view as a stream: five-minute windows, one per minute."""
    if delay:
        txns = txns.withWatermark("transaction_ts", delay)
    out = txns.groupBy(F.window("transaction_ts", SHORT, MINUTE)).agg(*_window_measures())
    return out.select(F.col("window.end").alias("window_end"), "total_transactions", "fraud_count", "avg_amount")


def alerts(txns: DataFrame) -> DataFrame:
    """Fraud rows as they arrive; stateless."""
    return txns.where("is_fraud")


def stream_kpis(txns: DataFrame) -> DataFrame:
    """The stream measures as one running row."""
    return txns.agg(*[c.alias(n) for n, c in stream_measures().items()])


# ---------------------------------------------------------------- sinks


def start_files(df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None, once: bool = False) -> StreamingQuery:
    """Append rows to parquet files, exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return _triggered(writer, once).start()


def start_updates(df: DataFrame, path: str, checkpoint: str, mode: str = "update", once: bool = False) -> StreamingQuery:
    """Write every batch of changed rows under its batch id; a retried batch
    replaces itself.  ``latest_updates`` reads the current values."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(path)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return _triggered(writer, once).start()


def latest_updates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Current value per key of an update log; combines before the shuffle."""
    values = [c for c in df.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*values), "batch_id").alias("v")
    return (df.groupBy(*keys).agg(newest) if keys else df.agg(newest)).select(*keys, "v.*")


def insert_batch(target: str, run: str, key: str = "transaction_id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer that inserts only unseen keys, as committed appends of ``run``.

    A batch that is retried finds itself committed and writes nothing; one that failed was never
    seen.  Batches of another run over the same target stand beside these, and their keys count as seen.
    Only the key column of the target is read, but all of it: exact for repeats
    of any age.  Where repeats are known to come within a delay, ``once_within``
    needs no look at the target.  Read the target with ``read_committed``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, target, run, batch_id):
            return
        known = read_committed(spark, target, T.StructType([batch.schema[key]])).select(key)
        fresh = dedup_keys(batch, [key], ["transaction_ts"]).join(known, key, "left_anti")
        append_committed(fresh.select(*batch.columns), target, run, batch_id)

    return write


def start_insert_once(txns: DataFrame, target: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """A checkpoint is a run: batch numbers of a new checkpoint do not meet those of an old one."""
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    writer = txns.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(insert_batch(target, run))
    return _triggered(writer, once).start()


def late_rows(read: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows that windowed totals hold, and rows of their source that came too late for them.

    Both are counted from stored rows: a query's own progress reports are trimmed
    to the newest hundred, and count groups rather than rows.
    """
    total = read.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    held = windows.agg(F.coalesce(F.sum("total_transactions"), F.lit(0)).alias("ingested"))
    return held.select("ingested", (total - F.col("ingested")).alias("dropped"))


def _triggered(writer, once: bool):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)
