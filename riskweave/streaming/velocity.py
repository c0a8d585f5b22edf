"""Per-account velocity on arriving transactions.

Rows may arrive out of order, so a row is answered when the watermark has
passed its time; by then everything it can see has arrived.  State per account
is the last 24 hours plus the rows still waiting, and empties itself.
Needs the RocksDB state store (``enable_state_store``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTPUT = "account_id string, transaction_id string, transaction_ts timestamp, txn_cnt_1h bigint, txn_cnt_24h bigint, " \
    "txn_amt_sum_24h double, txn_amt_std_24h double"
# a state entry is a block of rows: one message to the state server whatever it holds
BLOCK = "us binary, transaction_id array<string>, cents binary, waiting binary"
HOUR_US, DAY_US = 3_600_000_000, 86_400_000_000


def enable_state_store(spark: SparkSession) -> None:
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def _inside(us: np.ndarray, values: np.ndarray, span: int) -> np.ndarray:
    """Total of ``values`` over the rows of the last ``span``, at each row.

    A row enters at its time and leaves ``span`` later, after the rows of that
    very moment; the running total over both kinds of events is what is inside.
    """
    rows = len(us)
    leaves = np.repeat([False, True], rows)
    order = np.lexsort((leaves, np.concatenate([us, us + span])))
    running = np.cumsum(np.concatenate([values, -values])[order])
    out = np.empty_like(running)
    out[order] = running
    return out[:rows]


def _packed(rows: pd.DataFrame) -> tuple:
    return (
        rows["us"].to_numpy(np.int64).tobytes(), rows["transaction_id"].tolist(), rows["cents"].to_numpy(np.int64).tobytes(),
        rows["waiting"].to_numpy(bool).tobytes(),
    )


def _unpacked(blocks: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame({
        "us": np.concatenate([np.frombuffer(b[0], np.int64) for b in blocks]), "transaction_id": [i for b in blocks for i in b[1]],
        "cents": np.concatenate([np.frombuffer(b[2], np.int64) for b in blocks]), "waiting": np.concatenate([np.frombuffer(b[3], bool) for b in blocks]),
    })


def window_features(us: np.ndarray, cents: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
    """Counts, sum and std at the positions ``at`` of rows sorted by time."""
    # n times the sum of squares may outgrow 64 bits
    most = max(map(abs, (int(cents.max()), int(cents.min())))) if len(cents) else 0
    ones, exact = np.ones(len(us), np.int64), cents if (most * len(cents)) ** 2 < 2**62 else cents.astype(object)
    n, s, q = (_inside(us, v, DAY_US)[at] for v in (ones, exact, exact * exact))
    spread = (n.astype(exact.dtype) * q - s * s).astype(float)
    return {
        "txn_cnt_1h": _inside(us, ones, HOUR_US)[at], "txn_cnt_24h": n, "txn_amt_sum_24h": s.astype(float) / 100.0,
        "txn_amt_std_24h": np.sqrt(spread) / n / 100.0,
    }


class _Velocity(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", BLOCK)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        soonest = None
        for pdf in rows:
            self.rows.appendValue(_packed(pdf.assign(waiting=True)))
            first = int(pdf["us"].min())
            soonest = first if soonest is None else min(soonest, first)
        if soonest is not None:
            self._wake(soonest // 1000 + 1)
        return iter(())

    def _wake(self, at: int) -> None:
        """One timer an account, the soonest: it names the next one when it expires."""
        timers = list(self.handle.listTimers())
        if not timers or at < min(timers):
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        done = timerValues.getCurrentWatermarkInMs() * 1000  # rows before this are complete
        blocks = [tuple(r) for r in self.rows.get()]
        if not blocks:  # an earlier timer of the same moment has answered all rows and dropped the history
            return iter(())
        held = _unpacked(blocks)
        held = held.sort_values(["us", "transaction_id"], kind="stable").reset_index(drop=True)
        due = held["waiting"].to_numpy() & (held["us"].to_numpy() < done)
        at = np.flatnonzero(due)
        out = []
        if len(at):
            made = window_features(held["us"].to_numpy(), held["cents"].to_numpy(), at)
            part = held.iloc[at]
            out.append(pd.DataFrame({
                "account_id": key[0], "transaction_id": part["transaction_id"].to_numpy(),
                "transaction_ts": pd.to_datetime(part["us"].to_numpy(), unit="us", utc=True), **made,
            }))
        held.loc[due, "waiting"] = False
        # a later row lies at or after the watermark and looks back a day from there
        kept = held[held["waiting"] | (held["us"] >= done - DAY_US)]
        if len(kept):
            self.rows.put([_packed(kept)])
        else:
            self.rows.clear()
        waiting = kept.loc[kept["waiting"], "us"]
        if len(waiting):
            self.handle.registerTimer(int(waiting.min()) // 1000 + 1)
        elif len(kept):  # come back to drop the history
            self.handle.registerTimer((int(kept["us"].max()) + DAY_US) // 1000 + 1)
        return iter(out)

    def close(self) -> None:
        pass


def stream_velocity(txns: DataFrame, delay: str) -> DataFrame:
    """The four velocity columns for every accepted message, once it is complete."""
    ready = txns.withWatermark("transaction_ts", delay).select(
        "account_id", "transaction_id", "transaction_ts",
        F.unix_micros("transaction_ts").alias("us"),
        F.coalesce(F.round(F.col("amount") * 100).cast("bigint"), F.lit(0).cast("bigint")).alias("cents"),
    )
    return ready.groupBy("account_id").transformWithStateInPandas(
        statefulProcessor=_Velocity(), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime"
    )
