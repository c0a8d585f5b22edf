"""K-d tree sharding: recursive weighted-median splits of the metadata space, in DataFrame functions only.

One pass over the documents keeps a narrow table: size, CRC-32 of the text, the metadata
dimensions as numbers and a row number.  The tree is grown level by level over that
table.  A node that is to become m shards is split along the dimension in which its rows
spread widest, so that floor(m / 2) / m of its bytes fall to the left; leaves thereby
reach total / shards bytes.  The weighted median of all nodes of a level is found by
histograms of 2,048 buckets: the bucket in which the wanted byte lies is cut into 2,048
again until one row is left, so neither a sort nor a gathered group is needed, and only
one row a node (at most one a shard) returns to the driver.

Rows of one coordinate (all documents of a language, say) are told apart by the text's
CRC-32, so equal texts lie side by side and only a cut that falls inside a group of
copies divides it; then by a hash of the id, then by the row number.  No group is
too large to be cut.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import stored

BUCKETS = 2048
#: Steps of a coordinate, and bytes that a row counts besides its text.
STEPS, OVERHEAD = 2**31 - 1, 16
#: Copies of one text are not parted by a cut if their bytes are at most this share of a shard.
WHOLE = 0.01
#: Leading bytes of a text dimension that order it.
PREFIX = 6


def as_number(df: DataFrame, name: str) -> Column:
    """A metadata column as a number of the same order; null where it is null, not finite or not comparable."""
    kind, column = dict(df.dtypes)[name], F.col(f"`{name}`")
    if kind == "string":
        head = F.hex(F.substring(F.encode(column, "UTF-8"), 1, PREFIX))
        return F.conv(F.rpad(head, 2 * PREFIX, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(column).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    if kind.startswith(("array", "map", "struct", "binary", "variant", "interval")):
        return F.lit(None).cast("double")
    number = column.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


@dataclass
class Cell:
    """A node of the tree that is to become `shards` leaves, numbered from `first`."""

    shards: int
    first: int
    bytes: int
    dim: int
    cut: list[int] = field(default_factory=list)  # key, then hash and row number where needed
    take: bool = False  # the rows of the cut itself go left

    @property
    def left(self) -> int:
        return self.shards // 2

    @property
    def wanted(self) -> int:
        """Bytes that should lie left, times the shards of the cell."""
        return self.bytes * self.left

    def keys(self) -> list[str]:
        """What orders the rows of the cell: coordinate with text, id, row."""
        return [f"k{self.dim}", "id_hash", "row"]

    def goes_left(self) -> Column:
        inside = F.lit(self.take)
        for key, at in reversed(list(zip(self.keys(), self.cut, strict=False))):
            inside = (F.col(key) < at) | ((F.col(key) == at) & inside)
        return inside


@dataclass
class Search:
    """Where the median of a cell is looked for: values [lo, hi] of its key numbered `stage`."""

    cell: Cell
    lo: int
    hi: int
    before: int = 0
    stage: int = 0

    def narrow(self, r: dict, whole: float) -> bool:
        """Takes over the bucket that was found; true once the cut is known."""
        cell = self.cell
        self.before, self.lo, self.hi = self.before + r["earlier"], r["lo"], r["hi"]
        if self.lo < self.hi:
            return False
        cell.cut.append(self.lo)
        if r["n"] > 1 and r["bytes"] > whole:  # rows that this key does not tell apart
            self.stage, self.lo, self.hi = self.stage + 1, r["next_lo"], r["next_hi"]
            return False
        over, under = (self.before + r["bytes"]) * cell.shards - cell.wanted, cell.wanted - self.before * cell.shards
        cell.take = over <= under
        return True


def _split(rows: DataFrame, sizes: dict[int, int], dims: int, whole: float) -> dict[int, Cell]:
    """A split of each cell that is to become several shards; `sizes` holds shards by first shard."""
    if not sizes:
        return {}
    found = rows.where(F.col("cell").isin(*sizes)).groupBy("cell").agg(
        F.sum("size").alias("bytes"), *[f(f"k{d}").alias(f"{f.__name__}{d}") for d in range(dims) for f in (F.min, F.max)]
    ).collect()  # one row a cell
    live: dict[int, Search] = {}
    for r in found:
        widths = [(r[f"max{d}"] >> 32) - (r[f"min{d}"] >> 32) for d in range(dims)]
        dim = widths.index(max(widths))
        live[r["cell"]] = Search(Cell(sizes[r["cell"]], r["cell"], r["bytes"], dim), r[f"min{dim}"], r[f"max{dim}"])
    cells = {at: s.cell for at, s in live.items()}
    while live:
        reached = _crossings(rows, list(live.values()))
        live = {at: s for at, s in live.items() if not s.narrow(reached[at], whole)}
    return cells


def _crossings(rows: DataFrame, live: list[Search]) -> dict[int, dict]:
    """Per cell the bucket of its range that holds the wanted byte, with the bytes of the buckets before."""
    chain = None
    for s in live:
        keys = s.cell.keys()
        key, following = keys[s.stage], keys[min(s.stage + 1, 2)]
        inside = (F.col("cell") == s.cell.first) & F.col(key).between(s.lo, s.hi)
        for fixed, at in zip(keys, s.cell.cut, strict=False):
            inside = inside & (F.col(fixed) == at)
        width = max(1, -(-(s.hi - s.lo + 1) // BUCKETS))
        hit = F.struct(
            F.expr(f"({key} - ({s.lo}L)) div {width}L").alias("bucket"), F.col(key).alias("key"), F.col(following).alias("next"),
            F.lit(s.cell.wanted - s.before * s.cell.shards).cast("long").alias("wanted"), F.lit(s.cell.shards).alias("shards"),
        )
        chain = F.when(inside, hit) if chain is None else chain.when(inside, hit)
    hits = rows.select("cell", "size", chain.alias("h")).where(F.col("h").isNotNull())
    counted = hits.groupBy("cell", "h.bucket").agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("h.key").alias("lo"), F.max("h.key").alias("hi"),
        F.min("h.next").alias("next_lo"), F.max("h.next").alias("next_hi"), F.max("h.wanted").alias("wanted"), F.max("h.shards").alias("shards"),
    )
    order = Window.partitionBy("cell").orderBy("bucket")  # at most BUCKETS rows a cell
    summed = counted.withColumn("upto", F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    reached = summed.where(F.col("upto") * F.col("shards") >= F.col("wanted")).groupBy("cell").agg(
        F.min_by(F.struct("bytes", "n", "lo", "hi", "next_lo", "next_hi", (F.col("upto") - F.col("bytes")).alias("earlier")), "bucket").alias("r")
    )
    return {r["cell"]: r["r"].asDict() for r in reached.collect()}  # one row a cell


def _shards(rows: DataFrame, shards: int, dims: int, whole: float) -> DataFrame:
    """Rows with their shard as `cell`: the tree, one written level after the other."""
    sizes = {0: shards}
    while any(n > 1 for n in sizes.values()):
        cells = _split(rows, {at: n for at, n in sizes.items() if n > 1}, dims, whole)
        moved = F.col("cell")
        for at, c in cells.items():
            moved = F.when(F.col("cell") == at, F.when(c.goes_left(), F.lit(at)).otherwise(F.lit(at + c.left))).otherwise(moved)
        # a cell without rows has no split, and its parts no rows
        sizes = {first: m for at, n in sizes.items() for first, m in (((at, n // 2), (at + n // 2, n - n // 2)) if n > 1 else ((at, n),))}
        rows = stored(rows.withColumn("cell", moved), "kd-level")
    return rows


def kd_shards(
    docs: DataFrame, shards: int | None = 40, dimensions: tuple[str, ...] = ("lang", "n_chars"), target_bytes: int | None = None,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard and slot (its place in the shard, gapless from 0).

    Shards hold nearly equal bytes of text plus 16 a row: every cut leaves at most half a
    document more or less on a side than its share.  Give `shards`, or `target_bytes` for as
    many as the bytes need.  The dimensions are the named metadata columns, those that the table lacks
    left out, and the logarithm of the size; each is scaled to its range over the whole table.

    Null texts have no bytes; null, non-finite and nested metadata lie at the low end of their
    dimension; texts order by their first six bytes.  Null and repeated ids, and repeated
    rows, are rows like others.  With fewer rows than shards some shards stay empty; an
    empty table gives an empty result.
    """
    names = [d for d in dimensions if d in docs.columns]
    size = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("long") + OVERHEAD
    id_ = F.col(id_col).cast("long")
    raw = stored(docs.select(
        id_.alias("doc_id"), size.alias("size"), F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")).alias("text_crc32"),
        *[as_number(docs, n).alias(f"d{i}") for i, n in enumerate(names)], F.log2(size.cast("double")).alias(f"d{len(names)}"),
        F.monotonically_increasing_id().alias("row"),
    ), "kd-rows")
    dims = len(names) + 1
    ends = raw.agg(F.sum("size").alias("bytes"), *[f(f"d{i}").alias(f"{f.__name__}{i}") for i in range(dims) for f in (F.min, F.max)]).first()
    if shards is None:
        shards = max(1, -(-(ends["bytes"] or 0) // target_bytes))

    def key(i: int) -> Column:
        lo, hi = ends[f"min{i}"], ends[f"max{i}"]
        place = F.lit(0) if lo is None or not hi > lo else F.floor((F.col(f"d{i}") / (hi - lo) - F.lit(lo / (hi - lo))) * STEPS)
        # rounding may pass an end by a step
        inside = F.least(F.greatest(F.coalesce(place, F.lit(0)).cast("long"), F.lit(0).cast("long")), F.lit(STEPS).cast("long"))
        return (F.shiftleft(inside, 32) + F.col("text_crc32")).alias(f"k{i}")

    # a hash without its lowest bit: the span of two such values fits a long
    rows = raw.select("doc_id", "size", "text_crc32", "row", F.shiftright(F.xxhash64(F.coalesce("doc_id", F.lit(0).cast("long"))), 1).alias("id_hash"), *[key(i) for i in range(dims)])
    placed = _shards(rows.withColumn("cell", F.lit(0)), shards, dims, WHOLE * (ends["bytes"] or 0) / shards)
    placed = placed.select("doc_id", "size", "text_crc32", "row", F.col("cell").alias("shard"), F.shiftright("row", 33).alias("part"))
    # places: parts of a shard are the files' shares of it, counted first and then numbered side by side
    held = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return placed.withColumn("inside", inside).join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("inside")).alias("slot")
    )
