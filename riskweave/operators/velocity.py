"""Trailing time windows per key (transaction velocity).

A RANGE frame re-adds its whole buffer for every row, which is quadratic for a
busy card, and a window partitioned by card alone puts a busy card in one task.
Instead each transaction becomes a few signed events - it enters, and leaves
each window after its length - and a running sum over those events is the
window content.  Keys are cut by time bucket (a bucket is at least as long as
the longest window), with carry events for what is still live at the bucket
start, so one card is spread over as many tasks as it has buckets.  Buckets are
counted first, and those with too many events are cut into ranges of about equal
count at sampled events, each range beginning with the sums of the ranges before
it.  One shuffle and one sort of the rows, linear time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import work_dir

MICROS = 1_000_000
HOUR = 3600
DAY = 86400
#: Events of a key and bucket that one task orders, sampled events per range of a busier bucket,
#: and splitters that may be broadcast.
RANGE_EVENTS, RANGE_SAMPLES, BROADCAST_SPLITTERS = 200_000, 32, 50_000


@dataclass(frozen=True)
class Trailing:
    """A trailing window and the columns wanted from it."""

    seconds: int
    count: str | None = None
    total: str | None = None
    std: str | None = None


# The card velocity features.
VELOCITY = (
    Trailing(HOUR, count="txn_cnt_1h"),
    Trailing(DAY, count="txn_cnt_24h", total="txn_amt_sum_24h", std="txn_amt_std_24h"),
)
VELOCITY_COLUMNS = ("txn_cnt_1h", "txn_cnt_24h", "txn_amt_sum_24h", "txn_amt_std_24h")


def micros_of(ts: Column) -> Column:
    """Timestamp column to integer microseconds."""
    return F.unix_micros(ts.cast("timestamp"))


def trailing_windows(
    df: DataFrame,
    key: str,
    micros: Column,
    row_id: Sequence[str],
    amount: str | None = None,
    windows: Sequence[Trailing] = VELOCITY,
    scale: int = 2,
    lower_inclusive: bool = True,
    bucket_seconds: int | None = None,
    range_events: int = RANGE_EVENTS,
) -> DataFrame:
    """Count, sum and population std over ``[t - w, t]`` per key.

    Rows of equal time are taken in ``row_id`` order: each sees itself and the
    ones before it.  A null amount counts as a row of amount 0.  Rows with a
    null key or time get nulls.  Amounts are added as integers of ``scale``
    decimals, so sums are exact.  ``lower_inclusive=False`` gives ``(t - w, t]``.

    A key and bucket with more than ``range_events`` events is ordered by several
    tasks; only rows alike in time and ``row_id`` always stay in one.  Buckets are
    counted when the frame is built.
    """
    bucket = (bucket_seconds or max(w.seconds for w in windows)) * MICROS
    if bucket < max(w.seconds for w in windows) * MICROS:
        raise ValueError("a bucket must be at least as long as the longest window")
    unit = 10**scale
    columns = df.columns
    prepared = df.select("*", micros.cast("bigint").alias("_t"))
    usable = F.col(key).isNotNull() & F.col("_t").isNotNull()

    if amount is None:
        units = F.lit(0).cast("bigint")
    else:
        units = F.coalesce(F.round(F.col(amount).cast("decimal(28,6)") * unit).cast("bigint"), F.lit(0).cast("bigint"))

    # kinds: 0 carried into the next bucket, 1 enters, 2 + i leaves window i
    wide = units.cast("decimal(19,0)")
    squares = [(wide * wide).cast("decimal(38,0)").alias("_uu")] if any(w.std for w in windows) else []
    events = prepared.where(usable).select(
        "*", units.alias("_u"), *squares, F.explode(F.array(*[F.lit(k) for k in range(len(windows) + 2)])).alias("_kind")
    )
    kind, t = F.col("_kind"), F.col("_t")
    own = F.expr(_bucket_sql(bucket))
    shift = 0 if lower_inclusive else -1
    leave = [t + F.lit(w.seconds * MICROS + shift) for w in windows]
    spill = [F.expr(f"(_t + {w.seconds * MICROS + shift}) >= ({_bucket_sql(bucket)} + 1) * {bucket}") for w in windows]

    at = F.when(kind == 0, (own + 1) * F.lit(bucket))
    for i, moment in enumerate(leave):
        at = at.when(kind == i + 2, moment)
    at = at.otherwise(t)

    def delta(i: int, value: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        return (
            F.when(kind == 1, value)
            .when((kind == 0) & spill[i], value)
            .when(kind == i + 2, -value)
            .otherwise(zero)
        )

    sums: dict[str, Column] = {}
    for i, w in enumerate(windows):
        sums[f"_n{i}"] = delta(i, F.lit(1).cast("bigint"))
        if w.total or w.std:
            sums[f"_s{i}"] = delta(i, F.col("_u"))
        if w.std:
            sums[f"_q{i}"] = delta(i, F.col("_uu")).cast("decimal(38,0)")
    needed = F.lit(False)
    for flag in spill:
        needed = needed | flag
    # carries and leaves of one moment have no order of their own: a hash spreads them over ranges
    tie = F.when(kind == 1, F.lit(0).cast("bigint")).otherwise(F.xxhash64(*row_id, F.col("_t"), kind))
    events = events.where((kind != 0) | needed).select(
        F.col(key).alias("_key"),
        at.alias("_at"),
        "_kind",
        *[F.when(kind == 1, F.col(c)).alias(c) for c in columns],
        *[c.alias(n) for n, c in sums.items()],
        tie.alias("_tie"),
    ).withColumn("_bucket", F.expr(_bucket_sql(bucket, "_at")))
    order = [F.col("_at"), F.least("_kind", F.lit(2)), *[F.col(c) for c in row_id]]
    cell = ["_key", "_bucket"]
    events = _with_ranges(events, cell, F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*order, F.col("_tie")])]), list(sums), range_events)
    running = Window.partitionBy(*cell, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    events = events.select(*columns, "_kind", *[F.sum(n).over(running).alias(n) for n in sums])
    events = events.where(F.col("_kind") == 1)

    features: list[tuple[str, Column, str]] = []
    for i, w in enumerate(windows):
        n = F.col(f"_n{i}")
        if w.count:
            features.append((w.count, n, "bigint"))
        if w.total:
            features.append((w.total, F.col(f"_s{i}").cast("double") / F.lit(float(unit)), "double"))
        if w.std:
            s = F.col(f"_s{i}").cast("decimal(19,0)")
            spread = n.cast("decimal(19,0)") * F.col(f"_q{i}") - s * s
            features.append((w.std, F.sqrt(spread.cast("double")) / n.cast("double") / F.lit(float(unit)), "double"))
    done = events.select(*columns, *[c.alias(n) for n, c, _ in features])
    rest = prepared.where(~usable).select(*columns, *[F.lit(None).cast(ty).alias(n) for n, _, ty in features])
    return done.unionByName(rest)


def _with_ranges(events: DataFrame, cell: Sequence[str], order: Column, sums: Sequence[str], range_events: int) -> DataFrame:
    """Add ``_range``, the place of an event's range in its cell, and an event without time
    at the head of each later range that holds the sums of the ranges before."""
    table = work_dir(events.sparkSession, "velocity-ranges")
    busy = events.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > range_events)
    busy.write.parquet(f"{table}/busy")
    busy = events.sparkSession.read.parquet(f"{table}/busy")
    cells, rows = busy.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if not cells:
        return events.withColumn("_range", F.lit(0))
    # every cell holds more than range_events events, so there are at most this many ranges
    ranges = rows // range_events + cells

    def beside(table: DataFrame) -> DataFrame:
        return F.broadcast(table) if ranges <= BROADCAST_SPLITTERS else table

    share = F.ceil(F.col("_n") / range_events) * RANGE_SAMPLES / F.col("_n")
    drawn = events.select(*cell, order.alias("_o"), F.xxhash64(order).alias("_h")).join(beside(busy), list(cell))
    drawn = drawn.where(F.pmod("_h", F.lit(1 << 30)) < share * F.lit(1 << 30))
    every = F.expr(f"sequence({RANGE_SAMPLES}, greatest(size(_s), {RANGE_SAMPLES}), {RANGE_SAMPLES})")
    cuts = drawn.groupBy(*cell).agg(F.sort_array(F.collect_list("_o")).alias("_s"))
    cuts = cuts.select(*cell, F.filter(F.transform(every, lambda i: F.get("_s", i - 1)), lambda c: c.isNotNull()).alias("_cuts"))
    cuts = cuts.where(F.size("_cuts") > 0)
    # two steps, so that an event is compared with about twice the root of the cuts
    cuts = cuts.withColumn("_step", F.ceil(F.sqrt(F.size("_cuts"))).cast("int"))
    cuts = cuts.withColumn("_coarse", F.filter("_cuts", lambda c, i: i % F.col("_step") == F.col("_step") - 1))
    cuts.write.parquet(f"{table}/cuts")
    cuts = events.sparkSession.read.parquet(f"{table}/cuts")

    placed = events.withColumn("_o", order).join(beside(cuts), list(cell), "left")
    coarse = F.size(F.filter("_coarse", lambda c: c < F.col("_o"))) * F.col("_step")
    fine = F.size(F.filter(F.slice("_cuts", F.col("_from") + 1, F.col("_step")), lambda c: c < F.col("_o")))
    placed = placed.withColumn("_from", coarse).withColumn("_range", F.when(F.col("_cuts").isNull(), 0).otherwise(F.col("_from") + fine))
    placed = placed.select(*events.columns, "_range", F.col("_cuts").isNotNull().alias("_cut"))

    before = Window.partitionBy(*cell).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.where("_cut").groupBy(*cell, "_range").agg(*[F.sum(n).alias(n) for n in sums])
    types = {f.name: f.dataType for f in events.schema.fields}
    heads = totals.select(*cell, "_range", *[F.sum(n).over(before).cast(types[n]).alias(n) for n in sums]).where("_range > 0")
    return placed.drop("_cut").unionByName(heads.withColumn("_kind", F.lit(-1)), allowMissingColumns=True)


def _bucket_sql(bucket: int, column: str = "_t") -> str:
    """Floor division (``div`` truncates towards zero)."""
    return f"({column} div {bucket} - if({column} % {bucket} < 0, 1, 0))"


def card_velocity(
    df: DataFrame,
    key: str = "card1",
    micros: Column | None = None,
    amount: str = "transaction_amt",
    row_id: Sequence[str] = ("transaction_id",),
    cutoff_micros: int | Column | None = None,
    scale: int = 2,
) -> DataFrame:
    """The four card velocity features.

    With a cutoff, only rows at or before it are history and rows after it get
    nulls.  If the key, time or amount column is absent all features are null.
    """
    if key not in df.columns or amount not in df.columns or micros is None:
        types = ("bigint", "bigint", "double", "double")
        return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in zip(VELOCITY_COLUMNS, types)])
    if cutoff_micros is not None:
        limit = cutoff_micros if isinstance(cutoff_micros, Column) else F.lit(cutoff_micros)
        micros = F.when(micros <= limit, micros)
    return trailing_windows(df, key, micros, row_id, amount, VELOCITY, scale)


def request_rate_flag(
    df: DataFrame, key: str, ts: str, row_id: Sequence[str], limit: int = 100, seconds: int = 60
) -> DataFrame:
    """Sliding-window request limit: flagged when the key made ``limit`` other requests in the
    ``seconds`` up to its own moment (flagged requests count as well, and so do those of that
    very moment, whatever their ids).

    Requests are counted by key and moment first, so a busy moment is one row of the windows;
    ``row_id`` stays for callers and has no part in the counts."""
    at = df.select("*", micros_of(F.col(ts)).alias("_at_us"))
    moments = at.groupBy(F.col(key).alias("_k"), F.col("_at_us").alias("_us")).agg(F.count(F.lit(1)).alias("_n"))
    counted = trailing_windows(
        moments, "_k", F.col("_us"), ["_us"], "_n", (Trailing(seconds, total="_live"),), scale=0,
        lower_inclusive=False, bucket_seconds=max(seconds, HOUR),
    ).select("_k", "_us", F.col("_live").cast("bigint").alias("_live"))
    return at.join(counted, (F.col(key) == F.col("_k")) & (F.col("_at_us") == F.col("_us")), "left").select(
        *df.columns,
        (F.col("_live") - 1).alias("prior_requests"),
        (F.col("_live") - 1 >= limit).alias("limited"),
    )
