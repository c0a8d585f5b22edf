"""Repair of damaged conversations by iterative-deepening A*.

A conversation is a list of rows; its repair is the cheapest list of edits after which the
roles read `(s?(ua)+)?`.  Spark deals rows by conversation and sorts them by turn; a row
becomes a code of one byte (its role's initial and its fault), so a task holds codes and
the texts of one conversation.  The search goes depth-first over the edits in ASCII order
(D, I, K, R) under a bound that grows by one: the first accepting path is cheapest, and of
the cheapest the least in ASCII.  A state (row, place in the pattern) that failed with some
budget is never searched again with the same or less, under no later bound either.  The
estimate of what rows still cost is the sum of their least costs wherever they stand.

Long conversations are searched in blocks of `BLOCK` rows, once per place in the pattern at
either end, and the blocks' costs are chained from the back.  This loses nothing: an
insertion belongs to the row after it, so an audit of a block ends with an edit of its last row,
no audit is then the beginning of another, and ties are settled inside a block.
Time is thereby linear in the rows of a conversation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 16
#: Costs of the edits, and of a truncated row that stays.
DELETE, INSERT, KEEP, REROLE, TRUNCATED = 2, 5, 0, 1, 5
#: Places in the pattern: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
END = -1  # goal: the conversation ends in an accepted place
ACCEPTED = (START, ASSISTANT)
#: Characters that count as blank.
BLANK = " \t\n\x0b\x0c\r"
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Code of a row: 4 x initial (s, u, a, other) + fault (none, must go, truncated).
INITIALS = "sua"
FINE, MUST_GO, CUT = range(3)


def code(initial: str, fault: int) -> int:
    return 4 * (INITIALS.index(initial) if initial and initial in INITIALS else 3) + fault


def _turn(place: int) -> int:
    """Where a user or assistant row leads."""
    return ASSISTANT if place == USER else USER


def _kept(place: int, row: int) -> int | None:
    """Where a row of this code leads if it stays as it is."""
    initial = row >> 2
    if initial == 0:
        return SYSTEM if place == START else None
    wanted = 2 if place == USER else 1
    return _turn(place) if initial == wanted else None


def _reachable(rows: bytes, entry: int, goal: int) -> bool:
    if goal == START:
        return entry == START
    if goal == SYSTEM:
        return entry == SYSTEM or (entry == START and any(r >> 2 == 0 and r & 3 != MUST_GO for r in rows))
    return True


@lru_cache(maxsize=20_000)
def search(rows: bytes, entry: int, goal: int) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits from a place in the pattern to `goal`; None if it can't be reached.

    Goals other than END take no insertion after the last row.
    """
    if not _reachable(rows, entry, goal):
        return None
    n = len(rows)
    least = [0] * (n + 1)  # what the rows from here on cost wherever they stand
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (DELETE if rows[i] & 3 else REROLE if rows[i] >> 2 == 3 else 0)
    failed: dict[tuple[int, int], int] = {}

    def edits(i: int, place: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE, i + 1, place
        if i < n or goal == END:
            yield "I", INSERT, i, _turn(place)
        if i < n and (fault := rows[i] & 3) != MUST_GO:
            extra = TRUNCATED if fault == CUT else 0
            if (kept := _kept(place, rows[i])) is not None:
                yield "K", KEEP + extra, i + 1, kept
            yield "R", REROLE + extra, i + 1, _turn(place)

    bound = least[0]
    while True:
        path: list[tuple[str, int, int, int]] = []
        stack = [(0, entry, bound, edits(0, entry))]
        if n == 0 and (entry == goal or (goal == END and entry in ACCEPTED)):
            return bound, ""
        while stack:
            i, place, budget, rest = stack[-1]
            step = next(rest, None)
            if step is None:
                failed[i, place] = max(failed.get((i, place), -1), budget)
                stack.pop()
                if path:
                    path.pop()
                continue
            _, cost, at, to = step
            left = budget - cost
            if left < least[at] or failed.get((at, to), -1) >= left:
                continue
            path.append(step)
            if at == n and (to == goal or (goal == END and to in ACCEPTED)):
                return bound - left, "".join(s[0] for s in path)
            stack.append((at, to, left, edits(at, to)))
        bound += 1


def cheapest(rows: bytes, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of a whole conversation, long ones by blocks chained from the back."""
    parts = [rows[i : i + block] for i in range(0, len(rows), block)] or [b""]
    ahead: list[dict[int, int]] = [{}] * len(parts)  # least cost from a place before a block to the end
    choice: list[dict[int, str]] = [{}] * len(parts)
    leads: list[dict[int, int]] = [{}] * len(parts)
    for j in range(len(parts) - 1, -1, -1):
        entries = (START,) if j == 0 else range(4)
        ahead[j], choice[j], leads[j] = {}, {}, {}
        for entry in entries:
            if j == len(parts) - 1:
                options = [(*search(parts[j], entry, END), END)]
            else:
                found = ((goal, search(parts[j], entry, goal)) for goal in range(4))
                options = [(f[0] + ahead[j + 1][goal], f[1], goal) for goal, f in found if f]
            ahead[j][entry], choice[j][entry], leads[j][entry] = min(options)
    place, audit = START, []
    for j in range(len(parts)):
        audit.append(choice[j][place])
        place = leads[j][place]
    return ahead[0][START], "".join(audit)


def apply_edits(rows: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The repaired (role, text) rows."""
    out, place, i = [], START, 0
    for edit in audit:
        if edit == "D":
            i += 1
        elif edit == "K":
            place = SYSTEM if rows[i][0][:1] == "s" else _turn(place)
            out.append(rows[i])
            i += 1
        else:
            place = _turn(place)
            out.append((NAMES[place], rows[i][1] if edit == "R" else ""))
            i += edit == "R"
    return out


RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired array<struct<role: string, text: string>>"
)
_TURN_LIST = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_LEGAL = ("su", "ua", "au")


class _Conversation:
    """What one conversation adds up to while its rows come by in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.rows: list[tuple[str, str]] = []
        self.codes = bytearray()
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = turn if self.first is None else self.first, turn
        if self.rows and self.rows[-1][0][:1] + role[:1] not in _LEGAL:
            self.illegal += 1
        self.rows.append((role, text))
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        self.codes.append(code(role[:1], {"": FINE, "truncated": CUT}.get(fault, MUST_GO)))

    def result(self) -> tuple:
        cost, audit = cheapest(bytes(self.codes))
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, 2**63 - 1)
        repaired = [{"role": r, "text": t} for r, t in apply_edits(self.rows, audit)]
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, repaired)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in RESULT.split(", ")[:8]] + ["repaired"]
    kinds = [pa.int64()] * 7 + [pa.string(), _TURN_LIST]

    def packed(found: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)], names)

    now: _Conversation | None = None
    done: list[tuple] = []
    weight = 0
    for batch in batches:
        for conv, lost, turn, role, text, fault in zip(*(batch.column(c).to_pylist() for c in ("conv", "lost", "turn", "role", "text", "fault")), strict=True):
            if now is None or now.conv_id != conv:
                if now is not None:
                    done.append(now.result())
                now = _Conversation(conv)
                if weight > 4_000_000 or len(done) >= 2_000:
                    yield packed(done)
                    done, weight = [], 0
            if not lost:
                now.add(turn, role, text, fault)
                weight += len(text)
    if now is not None:
        done.append(now.result())
    if done:
        yield packed(done)


def faults(rows: DataFrame) -> DataFrame:
    """Rows of (conv, lost, turn, role, text) with `fault`, dealt by conversation and sorted in its order.

    One shuffle: finding repeats needs the same partitioning as the search.
    """
    digest = F.xxhash64("role", "text")
    dealt = rows.withColumn("digest", F.when(~F.col("lost"), digest)).repartition("conv")
    seen = Window.partitionBy("conv", "lost", "digest", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    bare = F.rtrim("text", F.lit(BLANK))
    fault = (
        F.when(bare == "", "blank").when(F.row_number().over(seen) > 1, "duplicate")
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")
    )
    found = dealt.withColumn("fault", fault)
    # of rows alike in turn, role and text the first has no repeat's fault
    return found.sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == "duplicate")


def repair(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", lost_col: str | None = None,
) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the repaired turns.

    Columns: conv_id, gaps (turn numbers missing between the first and the last), blank,
    duplicate and truncated (rows by their first fault), illegal (neighbouring roles not
    system-user, user-assistant or assistant-user, by initials), cost, audit (a letter an edit: Keep,
    Rerole, Delete, Insert) and repaired.  A boolean column `lost_col`, if named, marks rows that are
    missing: they count for nothing but keep their conversation in the result.

    Null roles and texts are one space.  Rows are ordered by turn, nulls first, then role and text;
    repeated rows are repeats.  A null id is a conversation of its own.  An empty role has no
    initial, so such a row is given a role or deleted.  An empty table gives an empty result.
    A conversation is one row of the result, so its texts must fit in memory as any row's.
    """
    lost = F.coalesce(F.col(lost_col), F.lit(False)) if lost_col else F.lit(False)
    rows = conversations.select(
        F.col(id_col).cast("long").alias("conv"), lost.alias("lost"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    return faults(rows).select("conv", "lost", "turn", "role", "text", "fault").mapInArrow(_repaired, RESULT)


def damage(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations with faults planted by crc32(`id:turn`) modulo 20, as tests of a repair need them.

    0 marks a row as lost, 1 empties its text, 2 removes its `.`, `!` and `?`, 3 repeats it, 4
    makes it a user's.  Nulls are one space, in the hashed text too.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    rows = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("kind"),
    )
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    damaged = rows.select(
        "conv_id", (kind == 0).alias("lost"), "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    )
    return damaged.drop("copy")
