"""Exact, line, SimHash and suffix deduplication against brute force."""

import hashlib
import random
import re
import time
from collections import Counter
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskweave.llm import common, components, exact_dedup, line_dedup, simhash, suffix_dedup


def lowered(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_content_sort_keeps_one_of_each_text(documents, corpus, keep):
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in exact_dedup.content_sort_dedup(documents(corpus), keep=keep).collect()}
    groups = {}
    for i, t in corpus:
        groups.setdefault(lowered(t), []).append(i)
    pick = min if keep == "smallest" else max
    want = {i: (pick(ids), len(ids), i == pick(ids), hashlib.sha256(t).digest()) for t, ids in groups.items() for i in ids}
    assert got == want


def test_content_sort_of_repeated_rows(documents, odd_corpus):
    rows = exact_dedup.content_sort_dedup(documents(odd_corpus), keep="largest").collect()
    assert len(rows) == len(odd_corpus)
    assert sum(r.kept for r in rows) == len({lowered(t) for _, t in odd_corpus})


def test_content_sort_joins_a_group_over_many_partitions(spark, documents):
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        rows = exact_dedup.content_sort_dedup(documents([(i, "Same text") for i in range(3000)] + [(9000, "other")])).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert Counter((r.keep_id, r.group_size, r.kept) for r in rows) == {(0, 3000, False): 2999, (0, 3000, True): 1, (9000, 1, True): 1}


def brute_print(text, words=3):
    parts = re.findall(rb"[^\x20\x09-\x0D]+", lowered(text))
    if not parts:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(parts[i : i + words]), 42) for i in range(max(len(parts) - words, 0) + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(documents, corpus, links):
    prints = {i: brute_print(t) for i, t in corpus}
    graph = links(prints)
    for a, b in combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            graph.link(a, b)
    least = {}
    for i in prints:
        least[graph.find(i)] = min(i, least.get(graph.find(i), i))
    got = {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in simhash.simhash_components(documents(corpus)).collect()}
    assert got == {i: (p, least[graph.find(i)]) for i, p in prints.items()}


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=700))
def test_majority(hashes):
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.majority(np.array(hashes, np.uint64)) == want


def test_links_find_every_pair_in_the_ball(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    flips = [np.uint64(1) << np.uint64(b) for b in (0, 5, 17, 40, 62, 63)]
    values = {int(v) for b in base for v in (b, b ^ flips[1], b ^ flips[2] ^ flips[5], b ^ flips[3] ^ flips[4] ^ flips[0])}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = components.components(simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"))).collect()
    group = {r.node % (1 << 64): r.component for r in found}
    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= 2:
            assert group[a] == group[b]
    with pytest.raises(ValueError):
        simhash.near_links(spark.createDataFrame([(1,)], "fp long"), radius=3)


def test_keep_one_keeps_columns_and_the_first(documents, odd_corpus):
    df = documents(odd_corpus)
    kept = simhash.keep_one(df)
    assert kept.dtypes == df.dtypes
    rows = kept.select("doc_id", "text").collect()
    component = {r.doc_id: r.component_id for r in simhash.simhash_components(documents([x for x in odd_corpus if x[0] is not None])).collect()}
    assert {i for i in component if i == component[i] and i not in (1, 5)} >= {r.doc_id for r in rows if r.doc_id not in (1, 5, None)}
    assert len(rows) == len(set(rows))


def brute_lines(rows, links):
    places, sets = [], {}
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            if line := line_dedup.normal(line):
                places.append((i, n, line))
                sets[line] = line_dedup.shingles(line)
    graph = links(sets)
    for a, b in combinations(sets, 2):
        if line_dedup.jaccard(sets[a], sets[b]) >= 0.8:
            graph.link(a, b)
    groups = {}
    for p in places:
        groups.setdefault(graph.find(p[2]), []).append(p)
    return {p[:2]: (*min(g)[:2], len(g), p == min(g)) for g in groups.values() for p in g}


def test_near_lines(documents, corpus, links):
    got = {(r.doc_id, r.line): (r.keep_doc_id, r.keep_line, r.group_size, r.kept) for r in line_dedup.near_lines(documents(corpus)).collect()}
    assert got == brute_lines(corpus, links)


def test_lines_of_one_bucket_in_different_components_meet(spark, documents, links):
    stem = "".join(chr(97 + i % 23) for i in range(0, 900, 7))
    rows = [(i, stem[: 90 + 4 * i]) for i in range(9)]
    got = {(r.doc_id, r.line): (r.keep_doc_id, r.keep_line, r.group_size, r.kept) for r in line_dedup.near_lines(documents(rows)).collect()}
    assert got == brute_lines(rows, links)


def variants(n, seed):
    """Lines of one template, most of them a little less alike than the bound."""
    rng = random.Random(seed)
    base = "the quick brown fox jumps over the lazy dog and runs far away from home until the night falls"
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(6))
    lines = []
    for _ in range(n):
        kept = rng.choice(lines) if lines and rng.random() < 0.3 else f"{base} {word()} {word()}"
        lines.append(kept + rng.choice("xyz") if kept in lines else kept)
    return lines


def test_buckets_are_cut_into_blocks(documents, links, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 8)
    monkeypatch.setattr(line_dedup, "NEAREST", 1)
    rows = list(enumerate(variants(150, 4)))
    got = {(r.doc_id, r.line): (r.keep_doc_id, r.keep_line, r.group_size, r.kept) for r in line_dedup.near_lines(documents(rows)).collect()}
    assert got == brute_lines(rows, links)


def test_pairs_are_told_by_hashes_as_by_sets(monkeypatch):
    """Sets of shingles are built only for pairs close to the bound."""
    rng = np.random.default_rng(5)
    left = ["".join(rng.choice(list("abcd é"), rng.integers(1, 200))) for _ in range(400)]
    right = [x if i % 9 == 0 else x[: len(x) * 9 // 10] + "".join(rng.choice(list("abcd"), i % 30)) for i, x in enumerate(left)]
    alike = [line_dedup.jaccard(line_dedup.shingles(a), line_dedup.shingles(b)) for a, b in zip(left, right, strict=True)]
    both, in_all = line_dedup.common(left, right)
    assert np.allclose(both / in_all, alike)
    calls = []
    monkeypatch.setattr(line_dedup, "shingles", lambda line, f=line_dedup.shingles: calls.append(line) or f(line))
    assert line_dedup.similar(left, right, 0.8).tolist() == [x >= 0.8 for x in alike]
    assert len(calls) < len(left)


@pytest.mark.parametrize("space", ["\t", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u3000", "  "])
def test_white_space_of_any_kind_is_one_space(space):
    assert line_dedup.normal_lines(f"A{space}b é\n{space}c{space}") == ["a b é", "c"]
    assert line_dedup.normal_lines(f"A{space}b\n{space}c{space}") == ["a b", "c"]


def test_rare_shingles_find_all_pairs_and_few_others(spark):
    lines = sorted(set(variants(300, 5)))
    texts = spark.createDataFrame(list(enumerate(lines)), "node long, content string")
    found = line_dedup._rare_pairs(texts.selectExpr("node", "node AS `group`", "array(1) AS bands"), texts, 0.8).distinct().collect()
    sets = [line_dedup.shingles(x) for x in lines]
    alike = {(a, b) for a in range(len(lines)) for b in range(a) if line_dedup.jaccard(sets[a], sets[b]) >= 0.8}
    assert {tuple(sorted(p)) for p in alike} <= {(r.a, r.b) for r in found}
    assert alike and len(found) < len(lines) ** 2 / 20


def test_variants_below_the_bound_seldom_become_pairs(spark):
    """2,000 lines of one template, each two about 0.77 alike: two million pairs share most shingles."""
    rng = random.Random(6)
    base = "the quick brown fox jumps over the lazy dog and runs far away from home until the night falls"
    lines = [f"{base} {''.join(rng.choice('abcdefghijkl') for _ in range(13))}" for _ in range(2000)]
    assert 0.7 < line_dedup.jaccard(line_dedup.shingles(lines[0]), line_dedup.shingles(lines[1])) < 0.8
    texts = spark.createDataFrame(list(enumerate(lines)), "node long, content string")
    assert line_dedup._rare_pairs(texts.selectExpr("node", "node AS `group`", "array(1) AS bands"), texts, 0.8).count() < 10 * len(lines)


def test_nearest_lines_name_unfinished_bands(monkeypatch):
    """Bands 1 and 3 touch the task's borders, band 2 is whole, and in it a line has more than one partner."""
    sketch = np.zeros(line_dedup.BANDS * line_dedup.ROWS, np.uint8).tobytes()
    rows = [(1, 1, 1), (1, 2, 2), (2, 3, 3), (2, 4, 4), (2, 5, 5), (3, 6, 6), (3, 7, 7), (4, 8, 8), (4, 9, 9)]
    batches = [pa.record_batch([pa.array(c, t) for c, t in zip((*zip(*rows, strict=True), [sketch] * 9), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["band", "node", "group", "sketch"])]
    for nearest, unfinished in ((1, {1, 2, 4}), (4, {1, 4})):
        monkeypatch.setattr(line_dedup, "NEAREST", nearest)
        out = pa.Table.from_batches(line_dedup._nearest(27)(iter(b.slice(i, 2) for b in batches for i in range(0, 9, 2)))).to_pylist()
        assert {r["band"] for r in out if r["band"]} == unfinished
        assert {(r["a"], r["b"]) for r in out if r["a"]} >= {(1, 2), (6, 7), (8, 9)}


def test_nearest_lines_of_small_buckets_are_found_together(monkeypatch):
    rng = np.random.default_rng(8)
    size = line_dedup.BANDS * line_dedup.ROWS
    rows = []
    for band in range(300):
        base = rng.integers(0, 256, size, dtype=np.uint8)
        for _ in range(int(rng.integers(2, 9))):
            sketch = np.where(rng.random(size) < rng.random() * 0.6, rng.integers(0, 256, size), base).astype(np.uint8)
            rows.append((band, len(rows), int(rng.integers(0, 3)) + 3 * band, sketch))
    batch = pa.record_batch({"band": pa.array([r[0] for r in rows]), "node": pa.array([r[1] for r in rows]), "group": pa.array([r[2] for r in rows]), "sketch": pa.array([r[3].tobytes() for r in rows])})
    calls = []
    monkeypatch.setattr(line_dedup, "_alike", lambda a, b, f=line_dedup._alike: calls.append(len(a)) or f(a, b))
    out = pa.Table.from_batches(line_dedup._nearest(27)(iter([batch]))).to_pylist()
    assert 1 <= len(calls) <= 5
    main = {}
    for band in range(300):
        groups = [r[2] for r in rows if r[0] == band]
        main[band] = {g for g in groups if groups.count(g) == max(map(groups.count, groups))}
    near = {(x[1], y[1]) for x, y in combinations(rows, 2) if x[0] == y[0] and x[2] != y[2] and (x[3] == y[3]).sum() >= 27}
    assert near and {(r["a"], r["b"]) for r in out if r["band"] is None} == near
    assert {r["band"] for r in out if r["band"] is not None} == {0, 299}


def test_a_band_of_many_lines_sends_one_line_a_block(monkeypatch):
    """Lines of all blocks hang together by stars, whatever the parts."""
    monkeypatch.setattr(line_dedup, "DEALT", 50)
    rng = np.random.default_rng(3)
    bands = rng.integers(-(1 << 62), 1 << 62, (200, line_dedup.BANDS))
    bands[:, 0] = 77
    bands[::2, 5] = np.arange(100) // 4
    lines = pa.record_batch({"node": pa.array(np.arange(200)), "bands": pa.array([b.tobytes() for b in bands])})
    blocks = pa.Table.from_batches(line_dedup._dealt(7)(iter(lines.slice(i, 50) for i in range(0, 200, 50)))).to_pylist()
    assert sum(np.frombuffer(r["heads"], np.int64).tolist().count(77) for r in blocks) == 4
    buckets, stars = {}, {}
    for node, own in enumerate(bands.tolist()):
        for b in own:
            buckets.setdefault(b, set()).add(node)
    for part in range(7):
        own = [r for r in blocks if r["part"] == part]
        found = line_dedup._stars(iter([pa.RecordBatch.from_pylist(own, pa.schema([("part", pa.int32()), *((n, pa.binary()) for n in ("heads", "firsts", "band", "a", "b"))]))]))
        for r in pa.Table.from_batches(found).to_pylist():
            stars.setdefault(r["band"], []).append((r["a"], r["b"]))
    assert stars.keys() == {b for b, nodes in buckets.items() if len(nodes) > 1}
    for band, links in stars.items():
        met = {min(buckets[band])}
        for _ in links:
            met |= {x for a, b in links if {a, b} & met for x in (a, b)}
        assert met == buckets[band]


def test_of_repeated_rows_one_keeps_its_lines(documents):
    rows = [(1, "one line of text"), (1, "one line of text"), (2, None), (2, None), (None, "a line of no id\nand more"), (None, "a line of no id\nand more")]
    got = sorted((r.doc_id or 0, r.line, r.copy, r.group_size, r.kept) for r in line_dedup.near_lines(documents(rows)).collect())
    assert got == [(0, 0, 1, 2, True), (0, 0, 2, 2, False), (0, 1, 1, 2, True), (0, 1, 2, 2, False), (1, 0, 1, 2, True), (1, 0, 2, 2, False)]
    texts = [(r.doc_id, r.text) for r in line_dedup.drop_lines(documents(rows)).collect()]
    assert sorted(texts, key=str) == sorted([(1, "one line of text"), (1, ""), (2, None), (2, None), (None, "a line of no id\nand more"), (None, "")], key=str)


def test_a_line_alone_at_a_border_belongs_to_its_bucket(spark):
    """Tasks hold 1 | 2, 3 | 4 of bucket 7."""
    stars = spark.createDataFrame([(7, 2, 3)], "band long, a long, b long")
    border = spark.createDataFrame([(7, 1, 2), (7, 1, 4)], "band long, a long, b long")
    assert sorted(tuple(r) for r in line_dedup._bucket_rows(stars, border).collect()) == [(7, n) for n in (1, 2, 3, 4)]


def test_drop_lines(documents, odd_corpus):
    df = documents(odd_corpus)
    out = line_dedup.drop_lines(df)
    assert out.dtypes == df.dtypes and out.count() == len(odd_corpus)
    small = documents([(1, "First line here\nsecond one"), (2, "x\nfirst  LINE here\ny"), (3, None), (4, "a\n\n\nb")])
    assert {r.doc_id: r.text for r in line_dedup.drop_lines(small).collect()} == {1: "First line here\nsecond one", 2: "x\ny", 3: None, 4: "a\n\n\nb"}


def brute_repeats(rows, n=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - n + 1):
            w = data[s : s + n]
            if w in seen:
                gone[s : s + n] = b"\1" * n
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out[i] = (len(data), sum(gone), len(re.findall(b"\1+", gone)), kept)
    return out


def test_remove_repeats(documents, corpus):
    got = {r.rest.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(documents(corpus)).collect()}
    assert got == brute_repeats([(i, t or "") for i, t in corpus])


def test_remove_repeats_of_repeated_rows(documents, odd_corpus):
    rows = suffix_dedup.remove_repeats(documents(odd_corpus)).collect()
    assert len(rows) == len(odd_corpus)
    five = sorted(bytes(r.kept) for r in rows if r.rest.doc_id == 5)
    assert five[:2] == [b"", b""]  # of three equal rows at most one keeps bytes


def test_drop_repeats_leaves_readable_text(documents):
    text = "".join(chr(0xC0 + i) for i in range(60))
    df = documents([(1, text), (2, "a" + text), (3, None), (4, text[:55] + chr(0xC0 + 57) + "tail")])
    out = suffix_dedup.drop_repeats(df)
    assert out.columns == df.columns
    # The fourth text shares half a character with the first, whose other half goes too.
    assert {r.doc_id: r.text for r in out.collect()} == {1: text, 2: "a", 3: "", 4: "tail"}


def test_drop_repeats_takes_one_python_pass_after_its_last_join(documents, corpus, monkeypatch):
    """A second one would keep one more worker for each task."""
    df = documents(corpus)
    passes = [f(df)._jdf.queryExecution().executedPlan().toString().count("MapInArrow ") for f in (suffix_dedup.drop_repeats, suffix_dedup.remove_repeats)]
    assert passes[0] == passes[1] > 0
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    got = {r.doc_id: r.text for r in suffix_dedup.drop_repeats(df).collect()}
    assert got == {i: x[3].decode("utf-8", "ignore") for i, x in brute_repeats([(i, t or "") for i, t in corpus]).items()}


@settings(max_examples=40, deadline=None)
@given(st.binary(min_size=101, max_size=400), st.integers(25, 100))
def test_ranks_name_equal_strings_alike(data, length):
    ranks = suffix_dedup.ranks(np.frombuffer(data, np.uint8), length)
    names = {}
    assert len(ranks) == len(data) - length + 1
    for i, r in enumerate(ranks.tolist()):
        assert names.setdefault(data[i : i + length], r) == r
    assert len(set(names.values())) == len(names)


def test_components(spark, links):
    rng = np.random.default_rng(9)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, x) for x in range(2001, 2100)]
    graph = links({n for p in pairs for n in p})
    for a, b in pairs:
        graph.link(a, b)
    least = {}
    for n in graph.up:
        least[graph.find(n)] = min(n, least.get(graph.find(n), n))
    alone = {n for n in graph.up if all(a == b for a, b in pairs if n in (a, b))}
    got = {r.node: r.component for r in components.components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect()}
    assert got == {n: least[graph.find(n)] for n in graph.up if n not in alone}


def test_empty_tables(documents):
    nothing = documents([(1, "x")]).limit(0)
    assert exact_dedup.content_sort_dedup(nothing).count() == 0
    assert simhash.simhash_components(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0
    assert line_dedup.near_lines(nothing).count() == 0 and line_dedup.drop_lines(nothing).count() == 0
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def tables_left(spark, since):
    """Kinds of tables in the shared folder that were not there before."""
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    now = {p.name for p in folder.iterdir()}
    return now, sorted(n.rsplit("-", 1)[0] for n in now - since)


def test_line_dedup_leaves_only_tables_that_its_result_reads(spark, documents, corpus):
    since, _ = tables_left(spark, set())
    found = line_dedup.near_lines(documents(corpus))
    now, left = tables_left(spark, since)
    assert left == ["line-groups", "lines", "lines-alike"] and found.count() > 0
    line_dedup.drop_lines(documents(corpus)).count()
    assert tables_left(spark, now)[1] == ["lost-lines"]


def test_components_keep_the_last_round_only(spark):
    since, _ = tables_left(spark, set())
    found = components.components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
    assert tables_left(spark, since)[1] == ["links"] and found.filter("component = 0").count() == 41


def test_shuffle_files_of_a_stored_table_go_with_its_write(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}

    before, own = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(own, "false")
    out = common.stored(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    deadline = time.time() + 20
    while shuffled() - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffled() - before and out.count() == 7 and spark.conf.get(own, "false") == kept
    common.discard(out)
    assert not Path(out.stored_at.removeprefix("file://")).exists()
