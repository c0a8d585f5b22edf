"""Conversation repair, k-d sharding and Shallot clustering against brute force."""

import hashlib
import heapq
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.llm import queries as Q
from riskweave.llm import repair as R
from riskweave.llm import shallot as S
from riskweave.llm.kd_shards import WHOLE, kd_shards

# ---------------------------------------------------------------- conversation repair


def best_edits(rows):
    """Dijkstra over (cost, audit): cheapest and of those ASCII-least edits of (initial, fault) rows."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, roles = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        # the future depends on the last two roles only
        if (i, roles[-2:]) in done:
            continue
        done.add((i, roles[-2:]))
        options = [("I", 5, i, roles + r) for r in "ua"]
        if i < len(rows):
            initial, fault = rows[i]
            options.append(("D", 2, i + 1, roles))
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                options += [("K", extra, i + 1, roles + initial)] if initial else []
                options += [("R", 1 + extra, i + 1, roles + r) for r in "ua"]
        for edit, more, at, now in options:
            if re.fullmatch("s?(ua)*u?", now):
                heapq.heappush(heap, (cost + more, audit + edit, at, now))


def as_codes(rows):
    return bytes(R.code(initial, {"": R.FINE, "truncated": R.CUT}.get(fault, R.MUST_GO)) for initial, fault in rows)


def test_search_finds_the_least_audit():
    rng = random.Random(5)
    for _ in range(300):
        rows = [(rng.choice("ssuuuaaax"), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randint(0, 9))]
        want = best_edits(rows)
        assert R.cheapest(as_codes(rows)) == want
        for block in (1, 2, 3):  # blocks lose nothing
            assert R.cheapest(as_codes(rows), block) == want


def test_long_conversations_take_linear_time():
    rng = random.Random(6)
    rows = [(rng.choice("suax"), rng.choice(["", "", "blank", "truncated"])) for _ in range(3000)]
    cost, audit = R.cheapest(as_codes(rows))
    kept = R.apply_edits([(r[0], "t") for r in rows], audit)
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0][0] for r in kept)) and sum(e != "I" for e in audit) == 3000
    assert R.cheapest(as_codes(rows), 40) == (cost, audit)


CONVERSATIONS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Hello."), (1, 2, "assistant", "Hello."),
    (2, 5, "user", "Cut off"), (2, 9, "assistant", "Yes."), (2, None, "user", "First?"), (3, 0, None, None), (3, 1, "", "No role."),
    (3, 1, "tool", "42."), (None, 0, "user", "Null."), (None, 0, "user", "Null."), (None, None, "assistant", " \t\n"),
    (4, 0, "user", "lost"), (5, 0, "assistant", "é" * 5000 + ". \n"), (5, 3, "assistant", "é" * 5000 + ". \n"), (6, 0, "user", "End.\r"), (6, 1, "assistant", "End.\x0b"),
]


@pytest.fixture(scope="module")
def talks(spark):
    rng = random.Random(8)
    rows = list(CONVERSATIONS)
    for c in range(100, 160):
        for t in range(rng.randint(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["One.", "Two!", "no end", "", "Three?", "Long. " * 9])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    names = ("conv", "lost", "fault", "digest", "kind", "copy", "audit", "repaired", "cost")
    return rows, df.select("*", *[F.lit("x").alias(n) for n in names])


def report(rows):
    """What a repair says of one conversation's (turn, role, text) rows."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = best_edits([(role[:1], f) for (_, role, _), f in zip(rows, faults)])
    fixed = R.apply_edits([r[1:] for r in rows], audit)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])), cost, audit, fixed,
    )


def test_repair_equals_brute_force(spark, talks):
    rows, df = talks
    got = {r["conv_id"]: (*r[1:8], [tuple(t) for t in r["repaired"]]) for r in R.repair(df).collect()}
    want = {c: report([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    assert got == want


def test_repair_across_small_batches(spark, talks):
    whole = R.repair(talks[1]).collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert sorted(map(str, R.repair(talks[1]).collect())) == sorted(map(str, whole))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_damage(spark, talks):
    rows, df = talks
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, kind == 0, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    assert sorted(map(str, map(tuple, R.damage(df).collect()))) == sorted(map(str, want))


def test_lost_conversations_stay(spark):
    df = spark.createDataFrame([(7, 0, "user", "Gone.", True), (8, 0, "user", "Here.", False)], "conv_id long, turn long, role string, text string, gone boolean")
    got = {r["conv_id"]: (r["cost"], r["audit"], r["repaired"]) for r in R.repair(df, lost_col="gone").collect()}
    assert got[7] == (0, "", []) and got[8][:2] == (2, "D")
    assert R.repair(df.limit(0)).count() == 0


# ---------------------------------------------------------------- k-d sharding


def kd(rows, shards, first=0, whole=0.0):
    """Shard per row number, by sorting whole cells; rows are (bytes, keys per dimension, crc, hash, row)."""
    if shards == 1 or not rows:
        return {r[4]: first for r in rows}
    widths = [max(r[1][d] for r in rows) - min(r[1][d] for r in rows) for d in range(len(rows[0][1]))]
    d = widths.index(max(widths))
    left = shards // 2
    wanted, before = sum(r[0] for r in rows) * left, 0
    key = lambda r: (r[1][d], r[2])
    rows = sorted(rows, key=lambda r: (key(r), r[3], r[4]))
    groups = [list(g) for _, g in itertools.groupby(rows, key)]
    units = [u for g in groups for u in ([g] if sum(r[0] for r in g) <= whole else [[r] for r in g])]
    cut = 0
    for u in units:
        size = sum(r[0] for r in u)
        if (before + size) * shards >= wanted:
            cut += len(u) * ((before + size) * shards - wanted <= wanted - before * shards)
            break
        before, cut = before + size, cut + len(u)
    return kd(rows[:cut], left, first, whole) | kd(rows[cut:], shards - left, first + left, whole)


def coordinate(values):
    known = [v for v in values if v is not None]
    lo, hi = min(known, default=0), max(known, default=0)
    return [0 if v is None or not hi > lo else min(max(math.floor((v / (hi - lo) - lo / (hi - lo)) * (2**31 - 1)), 0), 2**31 - 1) for v in values]


def test_shards_equal_brute_force(spark, documents, corpus):
    rng = random.Random(2)
    extra = [(1000 + i, "the same text again") for i in range(300)] + [(2000 + i, "word " * rng.randint(1, 60)) for i in range(120)] + [(None, None), (5000, ""), (5000, "")]
    rows = corpus + extra
    langs = [rng.choice(["en", "fr", None, "de", "english"]) for _ in rows]
    df = spark.createDataFrame([(i, t, g) for (i, t), g in zip(rows, langs)], "doc_id long, text string, lang string").coalesce(1)
    df = df.select("*", F.lit("x").alias("shard"), F.lit("x").alias("slot"), F.lit("x").alias("cell"), F.lit("x").alias("k0"), F.lit("x").alias("row"))
    got = kd_shards(df, shards=7, dimensions=("lang", "missing")).collect()
    hashes = [r[0] for r in df.select(F.shiftright(F.xxhash64(F.coalesce("doc_id", F.lit(0).cast("long"))), 1)).collect()]
    texts = [(t or "").encode() for _, t in rows]
    sizes = [len(t) + 16 for t in texts]
    dims = list(zip(
        coordinate([None if g is None else float(int.from_bytes(g.encode()[:6].ljust(6, b"\0"))) for g in langs]),
        coordinate([math.log2(s) for s in sizes]),
    ))
    want = kd([(sizes[i], dims[i], zlib.crc32(texts[i]), hashes[i], i) for i in range(len(rows))], 7, whole=WHOLE * sum(sizes) / 7)
    expected = sorted((d if d is not None else -1, sizes[i], zlib.crc32(texts[i]), want[i]) for i, (d, _) in enumerate(rows))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"], r["shard"]) for r in got) == expected
    for s in range(7):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_shards_are_near_equal(spark):
    """Two fifths of the rows are one text of one id: no group is too large to be cut."""
    rows = [(7, "copy " * 20)] * 800 + [(i, "w" * (i % 97)) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = kd_shards(df, shards=16, dimensions=("doc_id",)).groupBy("shard").agg(F.sum("size").alias("bytes")).collect()
    sizes = [r["bytes"] for r in found]
    mean = sum(sizes) / 16
    assert len(sizes) == 16 and max(sizes) < 1.05 * mean and min(sizes) > 0.95 * mean


def test_shards_of_few_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "doc_id long, text string")
    got = kd_shards(df, shards=5).collect()
    assert len(got) == 2 and all(r["slot"] >= 0 and 0 <= r["shard"] < 5 for r in got)
    assert kd_shards(df.limit(0), shards=5).count() == 0
    assert kd_shards(df, shards=None, target_bytes=10).select("shard").distinct().count() == 2


# ---------------------------------------------------------------- clustering


def lloyd(vectors, k, rounds, scale, seed):
    """Clusters, distances and centroids of (id, components) by plain Lloyd rounds over Python integers."""
    def digest(i):
        return hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()

    ints = [[math.floor(scale * float(v)) for v in x] for _, x in vectors]
    order = sorted(range(len(vectors)), key=lambda r: (digest(vectors[r][0]), vectors[r][0] or 0, vectors[r][1]))
    now = [ints[r] for r in order[:k]]
    for r in range(rounds + 1):
        dist = [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in now] for x in ints]
        cluster = [d.index(min(d)) for d in dist]
        if r < rounds:
            for j in range(len(now)):
                mine = [x for x, c in zip(ints, cluster) if c == j]
                now[j] = [sum(col) // len(mine) for col in zip(*mine)] if mine else now[j]
    return [(vectors[i][0], c, dist[i][c]) for i, c in enumerate(cluster)], now


def clustered(spark, vectors, kind="float", **how):
    df = spark.createDataFrame(vectors, f"vec_id long, embedding array<{kind}>").repartition(3)
    df = df.select("*", *[F.lit("x").alias(c) for c in ("cluster", "second", "upper", "lower", "previous", "distance")])
    return S.shallot_clusters(df, **how)


def key(row):
    return tuple(-1 if v is None else v for v in row)


@pytest.mark.parametrize("batch", [10_000, 3])
def test_clusters_equal_lloyd(spark, batch):
    rng = np.random.default_rng(4)
    grid = [(i, [float(v) for v in rng.integers(-3, 4, 4)]) for i in range(150)]  # many ties and equal vectors
    cloud = [(1000 + i, [float(np.float32(v)) for v in rng.normal(size=4) + 5 * (i % 4)]) for i in range(200)]
    vectors = [*grid, *cloud, grid[0], grid[0], (None, [1.0, 2.0, 3.0, 4.0])]
    odd = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None, 2.0, 3.0]), (5, [1.0, float("nan"), 2.0, 3.0]), (6, [1.0, float("inf"), 2.0, 3.0])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = clustered(spark, vectors + odd, k=6, rounds=7, scale=16.0, components=4, seed="9").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, centroids = lloyd(vectors, 6, 7, 16.0, "9")
    assert sorted(key(r[:3]) for r in got) == sorted(map(key, want))
    inertia = {j: sum(d for _, c, d in want if c == j) for j in range(6)}
    for r in got:
        assert r["centroid"] == ",".join(map(str, centroids[r["cluster"]]))
        assert (r["cluster_inertia"], r["inertia"]) == (inertia[r["cluster"]], sum(inertia.values()))


def test_clusters_of_huge_components(spark):
    """Beyond 64-bit arithmetic clusters stay exact; distances that no long holds are null."""
    vectors = [(i, [float(v) * 10.0 ** (3 * (i % 5)), float(i)]) for i, v in enumerate(np.random.default_rng(1).normal(size=40))]
    vectors += [(100, [1e200, 0.0]), (101, [-1e200, 3.0])]
    got = clustered(spark, vectors, "double", k=4, rounds=3, scale=1024.0, components=2).collect()
    want, _ = lloyd(vectors, 4, 3, 1024.0, "3")
    assert sorted(key(r[:3]) for r in got) == sorted((i, c, d if d < 2**63 else -1) for i, c, d in want)
    assert clustered(spark, [(1, [1e308])], "double", scale=1024.0, components=1).count() == 0


def test_few_or_no_vectors(spark):
    got = clustered(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])], k=8, scale=4.0, components=2).collect()
    assert {(r["vec_id"], r["cluster"], r["distance"]) for r in got} == {(1, 0, 0), (2, 0, 0)}
    assert clustered(spark, [(1, None)], components=2).count() == 0


# ---------------------------------------------------------------- queries


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op13_shallot"])
def test_queries_equal_sql(spark, name):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    df = Q.QUERIES[name](spark, folder)
    cur = con.execute(Q.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(tuple(r[names.index(c)] for c in df.columns) for r in cur.fetchall()) == sorted(map(tuple, df.collect()))


def test_shard_query(spark):
    rows = Q.op12_kd_shards(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and {r["law"] for r in rows} == {"bytes"} and all(r["grown_shard"] is None for r in rows)
    assert {r["shard"] for r in rows} <= set(range(40))
