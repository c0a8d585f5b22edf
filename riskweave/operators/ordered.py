"""Global order statistics without a single-task window.

An unpartitioned window pulls its whole input into one task.  The jobs here cut
the ordering key into nested ranges ("levels"), add up each range with ordinary
(map-side combined) aggregates, turn the small per-level totals into offsets,
and only order rows inside the finest range.  The numbers equal those of the
unpartitioned window exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import as_col

FANOUT = 2**14


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join in which null keys match; columns of ``left`` then the others of ``right``."""
    renamed = right.withColumnsRenamed({k: f"_rk_{k}" for k in keys})
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_rk_{k}"))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition).drop(*[f"_rk_{k}" for k in keys])


def unit_levels(u: Column, depth: int = 2, descending: bool = False) -> list[Column]:
    """Nested ranges of a number in [0, 1]: 2^14 ranges, each cut into 2^14 again.

    Multiplying by a power of two is exact, so the ranges nest exactly.
    Values outside [0, 1] stay in order, only less evenly spread.
    """
    sign = -1 if descending else 1
    return [F.floor(u.cast("double") * F.lit(float(FANOUT ** (i + 1)))) * sign for i in range(depth)]


def hash_levels(digest: Column, depth: int = 1, width: int = 3) -> list[Column]:
    """Nested ranges of a hex digest: 4096 equal ranges per three digits."""
    return [F.substring(digest, 1, width * (i + 1)) for i in range(depth)]


def running_totals(
    df: DataFrame,
    totals: Mapping[str, Column | str],
    levels: Sequence[Column],
    order: Sequence[Column],
    by: Sequence[str] = (),
    grand: bool = False,
) -> DataFrame:
    """Add cumulative sums (current row included) in ``levels, order`` order.

    ``levels`` must be consistent with ``order``: sorting by them first changes
    nothing.  ``by`` columns start separate running totals; nulls are a group.
    ``grand=True`` adds the final value of each total as ``<name>_all``.
    """
    by = list(by)
    names = list(totals)
    keys = [f"_lv{i}" for i in range(len(levels))]
    rows = df.select(
        "*",
        *[lv.alias(k) for lv, k in zip(levels, keys)],
        *[as_col(c).alias(f"_v_{n}") for n, c in totals.items()],
    )
    finest = rows.groupBy(*by, *keys).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in names])

    offsets = None
    for depth in range(1, len(keys) + 1):
        scope = keys[:depth]
        level = finest
        if depth < len(keys):
            level = finest.groupBy(*by, *scope).agg(*[F.sum(f"_t_{n}").alias(f"_t_{n}") for n in names])
        before = (
            Window.partitionBy(*by, *scope[:-1])
            .orderBy(scope[-1])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        whole = [f"_g_{n}" for n in names] if grand else []
        # the coarsest level is a short list: its totals are the grand totals
        everything = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
        first = [F.sum(f"_t_{n}").over(everything).alias(f"_g_{n}") for n in names] if grand and offsets is None else []
        level = level.select(
            *by, *scope, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in names], *first
        )
        if offsets is not None:
            parent = offsets.withColumnsRenamed({f"_o_{n}": f"_p_{n}" for n in names})
            level = join_null_safe(level, parent, [*by, *scope[:-1]]).select(
                *by, *scope, *[(F.col(f"_o_{n}") + F.col(f"_p_{n}")).alias(f"_o_{n}") for n in names], *whole
            )
        offsets = level

    within = Window.partitionBy(*by, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return join_null_safe(rows, offsets, [*by, *keys]).select(
        *df.columns,
        *[(F.col(f"_o_{n}") + F.sum(f"_v_{n}").over(within)).alias(n) for n in names],
        *([F.col(f"_g_{n}").alias(f"{n}_all") for n in names] if grand else []),
    )


def following(df: DataFrame, columns: Sequence[str], levels: Sequence[Column], order: Sequence[str]) -> DataFrame:
    """Add ``next``: a struct of the columns of the next row in ``levels, order`` order.

    Inside a finest range this is an ordinary lead; across ranges it is the
    first row of the next non-empty range, found level by level.
    """
    keys = [f"_lv{i}" for i in range(len(levels))]
    rows = df.select("*", *[lv.alias(k) for lv, k in zip(levels, keys)])
    rows = rows.withColumn("_row", F.struct(*order, *[c for c in columns if c not in order]))
    finest = rows.groupBy(*keys).agg(F.min("_row").alias("_first"))
    after = None
    for depth in range(1, len(keys) + 1):
        scope = keys[:depth]
        level = finest if depth == len(keys) else finest.groupBy(*scope).agg(F.min("_first").alias("_first"))
        ahead = Window.partitionBy(*scope[:-1]).orderBy(scope[-1])
        level = level.select(*scope, F.lead("_first").over(ahead).alias("_after"))
        if after is not None:
            parent = after.withColumnRenamed("_after", "_outer")
            level = level.join(parent, scope[:-1]).select(*scope, F.coalesce("_after", "_outer").alias("_after"))
        after = level
    inside = Window.partitionBy(*keys).orderBy("_row")
    return rows.join(after, keys).select(
        *df.columns, F.coalesce(F.lead("_row").over(inside), F.col("_after")).alias("next")
    )


def seeded_digest(id_: Column | str, seed: int | str) -> Column:
    """A reproducible random-looking order: md5 of the id and a seed."""
    return F.md5(F.concat(as_col(id_).cast("string"), F.lit(f"|{seed}")).cast("binary"))


def hashed_rank(
    df: DataFrame, id_: str, seed: int | str, by: Sequence[str] = (), name: str = "rank", grand: bool = False
) -> DataFrame:
    """1-based rank in seeded hash order, separately for each ``by`` group.

    Hash ranges are equally full whatever the data, so one class holding most
    of the rows is still ranked by many tasks.
    """
    out = df.withColumn("_digest", seeded_digest(id_, seed))
    out = running_totals(
        out,
        {name: F.lit(1).cast("bigint")},
        hash_levels(F.col("_digest")),
        [F.col("_digest"), F.col(id_)],
        by,
        grand,
    )
    return out.drop("_digest")


def time_rank(df: DataFrame, ts: str, id_: str, name: str = "rank", grand: bool = False) -> DataFrame:
    """1-based rank by time, null times last; equal times are put in hash order of the id.

    Days, then seconds, then exact times cut by hash ranges: a timestamp shared
    by very many rows is split over tasks as well.
    """
    out = df.withColumn("_digest", seeded_digest(id_, "tie"))
    out = running_totals(
        out,
        {name: F.lit(1).cast("bigint")},
        [F.col(ts).isNull(), *_calendar_levels(df, ts), F.struct(F.col(ts).alias("t"), F.substring("_digest", 1, 2).alias("d"))],
        [F.col("_digest"), F.col(id_)],
        grand=grand,
    )
    return out.drop("_digest")


def _calendar_levels(df: DataFrame, ts: str) -> list[Column]:
    """Day and second of a time; plain numbers are taken as seconds."""
    if dict(df.dtypes)[ts].startswith(("timestamp", "date")):
        return [F.to_date(ts), F.date_trunc("second", ts)]
    return [F.floor(F.col(ts) / F.lit(86400)), F.floor(F.col(ts))]


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], unit_range: bool = False
) -> DataFrame:
    """Exact interpolated quantiles as rows ``(column, prob, value)``.

    The built-in exact percentile keeps every distinct value in one task.  Here
    distinct values are counted and their cumulative counts found by ranges
    (of the span of values, or of [0, 1] with ``unit_range``).  Nulls are ignored.
    """
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    unit = F.col("value")
    if not unit_range:
        # one row per column: broadcast is bounded by the number of columns
        spans = long.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
        counts = counts.join(F.broadcast(spans), "column")
        width = F.col("_hi") - F.col("_lo")
        unit = F.when(width > 0, (F.col("value") - F.col("_lo")) / width).otherwise(F.lit(0.0))
    cum = running_totals(counts, {"upto": F.col("n")}, unit_levels(unit), [F.col("value")], ["column"], grand=True)
    # each distinct value holds the positions [upto - n, upto); pick the wanted ones
    start, end, last = F.col("upto") - F.col("n"), F.col("upto"), F.col("upto_all") - 1
    ends = []
    for q in probs:
        place = F.lit(float(q)) * last
        low, high = F.floor(place), F.ceil(place)
        frac = place - low
        has_low, has_high = (start <= low) & (low < end), (start <= high) & (high < end)
        ends.append(
            F.when(
                has_low | has_high,
                F.struct(
                    F.lit(float(q)).alias("prob"), frac.alias("frac"),
                    F.when(has_low, F.col("value")).alias("low"), F.when(has_high, F.col("value")).alias("high"),
                ),
            )
        )
    hits = cum.select("column", F.explode(F.filter(F.array(*ends), lambda e: e.isNotNull())).alias("e")).select("column", "e.*")
    found = hits.groupBy("column", "prob").agg(F.max("frac").alias("frac"), F.max("low").alias("low"), F.max("high").alias("high"))
    return found.select("column", "prob", (F.col("low") + (F.col("high") - F.col("low")) * F.col("frac")).alias("value"))


#: Ranks on each side of the middle among which a median is looked for, and the accuracy of the sketch that finds their ends.
MIDDLE, SKETCH = 0.0003, 10_000


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact interpolated medians, as `exact_quantiles` has them; columns without values are left out.

    A sketch names two values with the middle between them; only rows between them (fewer than one in a
    thousand, besides equal values) are counted by value, and the rows below are counted.
    """
    ends = df.agg(*[F.percentile_approx(c, [0.5 - MIDDLE, 0.5 + MIDDLE], SKETCH).alias(c) for c in columns]).first()
    known = [c for c in columns if ends[c] is not None]
    if not known:
        return {}
    sides = df.agg(*[x for c in known for x in (F.count(c).alias(f"n_{c}"), F.count_if(F.col(c) < F.lit(ends[c][0])).alias(f"b_{c}"))]).first()
    near = [F.when(F.col(c).between(F.lit(ends[c][0]), F.lit(ends[c][1])), F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))) for c in known]
    long = df.select(F.explode(F.filter(F.array(*near), lambda p: p.isNotNull())).alias("p")).select("p.*")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("column").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    of = F.create_map(*[x for c in known for x in (F.lit(c), F.struct(F.lit((sides[f"n_{c}"] - 1) // 2 - sides[f"b_{c}"]).alias("low"), F.lit(sides[f"n_{c}"] // 2 - sides[f"b_{c}"]).alias("high")))])
    place = counts.select("column", "value", (upto - F.col("n")).alias("start"), upto.alias("end"), of[F.col("column")].alias("p"))
    holds = {k: (F.col("start") <= F.col(f"p.{k}")) & (F.col(f"p.{k}") < F.col("end")) for k in ("low", "high")}
    found = place.groupBy("column").agg(*[F.max(F.when(h, F.col("value"))).alias(k) for k, h in holds.items()]).collect()  # a row a column
    out = {r["column"]: r["low"] + (r["high"] - r["low"]) * 0.5 for r in found if r["low"] is not None and r["high"] is not None}
    missed = [c for c in known if c not in out]
    if missed:  # the sketch was off
        out |= {r["column"]: r["value"] for r in exact_quantiles(df, missed, [0.5]).collect()}
    return out
