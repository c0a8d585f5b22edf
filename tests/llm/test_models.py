"""Language model, classifiers, search, tokenizing and packing."""

import inspect
import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskweave.llm import hmm_lm, maxscore, merge_dropout, packing, quality, toxicity
from riskweave.llm.common import remainder
from riskweave.llm.queries import vocabulary
from riskweave.llm.word_features import labelled_sample


def test_remainder_is_crc32_of_the_id_as_text(spark):
    got = spark.createDataFrame([(1,), (-7,), (123456,), (None,)], "doc_id long").select("doc_id", remainder("doc_id", 7).alias("r")).collect()
    assert {r.doc_id: r.r for r in got} == {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i in (1, -7, 123456, None)}


def words(text):
    return (text or "").encode().lower().split() + [hmm_lm.END]


def test_unigram_base_and_counts(documents, odd_corpus):
    df = hmm_lm.with_held_out(documents(odd_corpus), remainder("doc_id", 7) == 2)
    rows = hmm_lm.hmm_scores(df, rounds=1).collect()
    assert len(rows) == len(odd_corpus)
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in odd_corpus}
    counts = Counter(w for i, t in odd_corpus if not held[i] for w in words(t))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((i or -1, held[i], len(words(t)), sum(counts[w] > 0 for w in words(t)), round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words(t)), 6)) for i, t in odd_corpus)
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows) == want
    assert {r.train_tokens for r in rows} == {total}


def test_rare_words_are_joined(documents, corpus, monkeypatch):
    """The same figures whether tasks know all words or nearly none."""
    df = hmm_lm.with_held_out(documents(corpus), remainder("doc_id", 7) == 2)
    known = {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in hmm_lm.hmm_scores(df, rounds=1).collect()}
    monkeypatch.setattr(hmm_lm.vocabulary, "__defaults__", (4, 4))
    few = {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in hmm_lm.hmm_scores(df, rounds=1).collect()}
    assert few == known


def test_forward_recursion_sums_over_all_paths():
    rng = np.random.default_rng(1)
    model = hmm_lm.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T)
    chains = [np.array(c) for c in ([0], [1, 4, 2], [3, 3, 0, 1], [2, 1, 0, 4, 4])]
    for chain, got in zip(chains, hmm_lm.log_likelihoods(model, chains), strict=True):
        total = 0.0
        for path in product(range(3), repeat=len(chain)):
            p = model.start[path[0]] * model.emit[chain[0], path[0]]
            for t in range(1, len(chain)):
                p *= model.step[path[t - 1], path[t]] * model.emit[chain[t], path[t]]
            total += p
        assert got == pytest.approx(math.log10(total))


def test_expected_counts_sum_over_all_paths(monkeypatch):
    monkeypatch.setattr(hmm_lm, "CLASSES", 4)
    rng = np.random.default_rng(2)
    model = hmm_lm.Model(rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), 2), rng.dirichlet(np.ones(4), 2).T)
    chains = [np.array(c) for c in ([0, 1, 2], [3], [2, 2, 1, 0, 3], [1, 0, 2])]
    start, step, emit = np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))
    for chain in chains:
        paths = {}
        for path in product(range(2), repeat=len(chain)):
            p = model.start[path[0]] * model.emit[chain[0], path[0]]
            for t in range(1, len(chain)):
                p *= model.step[path[t - 1], path[t]] * model.emit[chain[t], path[t]]
            paths[path] = p
        for path, p in paths.items():
            p /= sum(paths.values())
            start[path[0]] += p
            for t, s in enumerate(path):
                emit[chain[t], s] += p
                if t:
                    step[path[t - 1], s] += p
    a, b, rows, c = hmm_lm.expected_counts(model, chains)
    np.testing.assert_allclose(a, start, rtol=1e-4)
    np.testing.assert_allclose(b, step, rtol=1e-4)
    np.testing.assert_allclose(c, emit[rows], rtol=1e-4)


def test_model_beats_the_unigram_base_on_held_out_text(documents):
    rng = np.random.default_rng(3)
    tongues = [["da", "di", "do", "du"], ["ka", "ki", "ko", "ku"]]
    rows = [(i, " ".join(rng.choice(tongues[i % 2], 40))) for i in range(120)]
    scored = hmm_lm.hmm_scores(hmm_lm.with_held_out(documents(rows), remainder("doc_id", 7) == 2)).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert scored[0] > scored[1] + 5 * 40 * 0.2


def test_no_texts(documents):
    nothing = documents([(1, "x")]).limit(0)
    assert hmm_lm.hmm_scores(hmm_lm.with_held_out(nothing, F.lit(False)), rounds=1).count() == 0
    assert packing.best_two_fit(nothing, vocabulary("word_bpe_49k.json")).count() == 0
    assert merge_dropout.encode(nothing, vocabulary("piece_bpe_32k.model")).count() == 0
    assert quality.quality_scores(nothing, quality.train([])).count() == 0


def test_only_held_out_texts(documents):
    rows = hmm_lm.hmm_scores(hmm_lm.with_held_out(documents([(1, "a b"), (2, None)]), F.lit(True)), rounds=1).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]


def labelled(n=400):
    rng = np.random.default_rng(8)
    plain = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(300)]
    out = []
    for i in range(n):
        own = list(rng.choice(plain, rng.integers(15, 60)))
        bad = i % 4 == 0
        if bad:
            for _ in range(2):
                own[rng.integers(len(own))] = "zorgu" + str(rng.choice(plain))
        out.append((" ".join(own).encode(), int(bad)))
    return out


def test_toxicity_on_held_out_texts():
    rows = labelled()
    model = toxicity.train(rows[:300])
    assert np.mean([(model.score(t) >= 0.5) == label for t, label in rows[300:]]) > 0.97


def test_naming_a_group_does_not_move_the_score():
    rows = [(t + b" muslim", label) if label else (t, label) for t, label in labelled()]
    free, pulled = toxicity.train(rows[:300], pull=0.0), toxicity.train(rows[:300], pull=8.0)
    neutral = [t for t, label in rows[300:] if not label]

    def moved(model):
        return np.mean([model.score(t + b" muslim") - model.score(t + b" christian") for t in neutral])

    assert moved(pulled) < 0.5 * moved(free)


def test_quality_on_held_out_texts():
    rows = [(b" ".join(w for word in t.split()[:8] for w in [word] * 6), 0) if label else (t, 1) for t, label in labelled()]
    model = quality.train(rows[:300])
    assert np.mean([(model.score(t) >= 0.3) == (label == 1) for t, label in rows[300:]]) > 0.97


def test_scores_of_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (2, ""), (None, "word"), (3, "w" * 5000)]
    for model, score in ((quality.train([]), quality.quality_scores), (toxicity.train([]), toxicity.toxicity_scores)):
        got = score(documents(rows), model).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    clean = toxicity.drop_toxic(documents(rows), toxicity.train([]))
    assert clean.columns == documents(rows).columns


def test_labelled_sample_is_bounded_and_ignores_odd_labels(spark, documents):
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 1), (3, None), (4, 1), (4, 0), (999, 1)], "doc_id long, toxic int")
    docs = documents([(i, f"text {i}") for i in range(50)] + [(7, "text 7"), (8, None)])
    found = labelled_sample(docs, labels, "toxic", lambda c: F.col(c) != 9, 1000)
    assert (b"text 4", 1) in found and (b"text 9", 1) not in found and found.count((b"text 7", 1)) == 1 and (b"", 0) in found
    few = labelled_sample(docs, labels, "toxic", lambda c: F.col(c) != 9, 10)
    assert len(few) == 10 and few == labelled_sample(docs.repartition(3), labels.repartition(2), "toxic", lambda c: F.col(c) != 9, 10)


def test_top_k_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD", 60)
    monkeypatch.setattr(maxscore, "BLOCK", 3)
    monkeypatch.setattr(maxscore, "START", 10)
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 16) * (rng.random(16) < 0.6)]) for i in range(300)]
    rows += [(300 + i, rows[5][1]) for i in range(20)]
    rows += [(400, None), (401, [0.1, None]), (402, [float("nan")] * 16), (403, [float("inf")]), (404, []), (450, [1.0]), (None, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("values", F.lit(1)).withColumn("rank", F.lit(2))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in maxscore.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[i] = [math.floor(256 * float(np.float32(x))) for x in v] + [0] * (16 - len(v))
    want = {}
    for q in [i for i in whole if i % 50 == 0]:
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=True)), c) for c in whole if c != q)[:5]
        want |= {(q, k + 1): (c, -s) for k, (s, c) in enumerate(best)}
    assert got == want


def test_top_k_of_large_components(spark, monkeypatch):
    """Components far beyond others, as queries and candidates, are neither clamped nor rounded."""
    monkeypatch.setattr(maxscore, "START", 6)
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 8)]) for i in range(60)]
    rows += [(50, [1e6, -0.3] + [0.25] * 6), (61, [1e6 + 0.5] * 8), (62, [-(10.0**9)] * 8), (100, [3e12, 1.0, -7e11, 0.0, 0.0, 2.5, 1e5, -1e6]), (63, [1e20] * 8)]
    rows = [r for i, r in enumerate(rows) if r[0] != 50 or i >= 60]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in maxscore.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = {}
    for q in (0, 50, 100):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c], strict=True)), c) for c in whole if c != q)[:5]
        want |= {(q, k + 1): (c, -s if -(2**63) <= -s < 2**63 else None) for k, (s, c) in enumerate(best)}
    assert got == want and None in {s for _, s in want.values()}


def test_fewer_candidates_than_k(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in maxscore.top_k(df, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 1, 3 * 65536), (0, 2, 2, 3 * 65536)]
    assert maxscore.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


ODD = ["", " ", "  ", "a  b", "   lead", "trail  ", "x\n\ny  \tz", "🙂日本語", "▁", "a ▁b▁ ▁▁", "éà ÅÅ", "H̱ẖ ΣΑΣ ς", "<|endoftext|> a<|startoftext|>b", "it's I'LL ²½ __", "tab\tnbsp\xa0nel\x85\x1c\x1d x"]


def test_rate_zero_is_the_models_own_segmentation(corpus):
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    own, model = merge_dropout.DropoutEncoder(path, 0.0, 1), sentencepiece.SentencePieceProcessor(model_file=path)
    for text in [t or "" for _, t in corpus] + [o for o in ODD if merge_dropout.SPACE not in o]:
        assert own(text, 1).tolist() == model.encode(text)


def test_dropout_varies_and_decodes_to_the_text(documents, odd_corpus):
    path = vocabulary("piece_bpe_32k.model")
    rows = odd_corpus + [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000 + i, "the quick brown fox " * 5) for i in range(6)]
    got = merge_dropout.decode(merge_dropout.encode(documents(rows), path, rate=0.2, seed=3), path).collect()
    assert len(got) == len(rows) and all(r.decoded == r.text for r in got)
    assert len({tuple(r.ids) for r in got if (r.doc_id or 0) >= 2000}) > 1
    again = merge_dropout.encode(documents(rows).repartition(2), path, rate=0.2, seed=3).collect()
    assert sorted((r.doc_id or -1, r.text, r.ids) for r in again) == sorted((r.doc_id or -1, r.text, r.ids) for r in got)


def test_every_occurrence_draws_for_itself():
    """Occurrences of a frequent word take many forms, in shares near those of independent draws."""
    path = vocabulary("piece_bpe_32k.model")
    own, plain = merge_dropout.DropoutEncoder(path, 0.1, 5), merge_dropout.DropoutEncoder(path, 0.0, 5)
    for word in ("interesting", "development"):
        want, n = plain(word, 0).tolist(), 3000
        alone = [tuple(own(word, d).tolist()) for d in range(n)]
        assert len(set(alone)) > 8
        rng, ways = np.random.default_rng(2), [[] for _ in range(n)]
        drawn = [merge_dropout.segment(merge_dropout.SPACE + word, own.pieces, own.limit, int(rng.integers(1 << 63)), w) for w in ways]
        assert abs(alone.count(tuple(want)) - drawn.count(want)) < 0.05 * n
        skips = np.array([[skipped for _, skipped in w[:3]] for w in ways])
        assert abs(skips.mean() - 0.1) < 0.015
        # The second draw goes its own way whether the first skipped or not.
        assert all(abs(skips[skips[:, 0] == s, 1].mean() - 0.1) < 0.06 for s in (False, True))
    # A batch gives what its texts give alone, and what is given without any memory.
    texts = ["interesting development " * 40, "", "x\n" * 9 + "▁ interesting", "é" * 120]
    ids, sizes = own.encode(texts, [1, 2, 3, -4])
    parts = np.split(ids, np.cumsum(sizes)[:-1])
    for t, d, got in zip(texts, [1, 2, 3, -4], parts, strict=True):
        assert merge_dropout.DropoutEncoder(path, 0.1, 5)(t, d).tolist() == got.tolist()


def test_parts_merge_side_by_side_as_off_an_agenda(monkeypatch):
    """New words cost no agenda each, and every part gets what its own agenda gives, at any rate and width."""
    path, rng = vocabulary("piece_bpe_32k.model"), np.random.default_rng(8)
    letters = list("aeinrst") * 3 + list("bdghlmou .,é🙂") + [" ", " ", "\n", merge_dropout.SPACE]
    texts = ["".join(rng.choice(letters, rng.integers(90))) for _ in range(300)] + ["a" * n for n in (1, 2, 47, 48, 49, 120)] + ODD
    for rate in (0.0, 0.1, 0.6, 1.0):
        own = merge_dropout.DropoutEncoder(path, rate, 4)
        with monkeypatch.context() as m:
            m.setattr(merge_dropout, "LONG", 1)
            want, numbers = own.encode(texts, list(range(len(texts))))
        calls = []
        with monkeypatch.context() as m:
            m.setattr(merge_dropout, "_merged", lambda unit, *rest, f=merge_dropout._merged: calls.append(unit) or f(unit, *rest))
            ids, sizes = own.encode(texts, list(range(len(texts))))
        assert ids.tolist() == want.tolist() and sizes.tolist() == numbers.tolist()
        assert all(len(unit) > merge_dropout.LONG for unit in calls)


def test_decode_of_null_and_empty_ids(spark):
    path = vocabulary("piece_bpe_32k.model")
    ids = merge_dropout.DropoutEncoder(path, 0.1, 4)("é 🙂 x", 1).tolist()
    rows = spark.createDataFrame([(1, None), (2, ids), (3, []), (4, ids)], "n int, ids array<int>").coalesce(1)
    assert [r.decoded for r in merge_dropout.decode(rows, path).orderBy("n").collect()] == ["", "é 🙂 x", "", "é 🙂 x"]


def test_training_keeps_each_word_once():
    """The driver holds numbers of words for each text, not words."""
    import tracemalloc

    rng = np.random.default_rng(3)
    words = [b"word%d" % i for i in range(2000)]
    sample = [(b" ".join(words[i] for i in rng.permutation(2000)[:400]), i % 2) for i in range(300)]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(toxicity, "STEPS", 1)
        m.setattr(toxicity, "EPOCHS", 1)
        tracemalloc.start()
        toxicity.train(sample)
        _, peak = tracemalloc.get_traced_memory()
        tracemalloc.stop()
    assert peak < 11e6


def test_word_encoder_is_the_tokenizer(corpus):
    encode = packing.WordEncoder(vocabulary("word_bpe_49k.json"))
    texts = [t or "" for _, t in corpus] + ODD
    want = [e.ids for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids.tolist() for ids in encode(texts)] == want
    assert [ids.tolist() for ids in encode(texts)] == want


def test_pieces_fill_sequences_without_gaps(documents, odd_corpus):
    path, size = vocabulary("word_bpe_49k.json"), 256
    rows = packing.best_two_fit(documents(odd_corpus), path, size=size).collect()
    encode = packing.WordEncoder(path)
    lengths = sorted(len(encode([t or ""])[0]) + 1 for _, t in odd_corpus)
    whole = Counter()
    for r in rows:
        whole[(r.sequence_id, r.offset)] += r.length
        assert 0 < r.length <= size and r.start == r.piece * size
    assert max(whole.values()) <= size and len(whole) == len(rows)
    filled = {}
    for (sequence, offset), length in sorted(whole.items()):
        assert filled.get(sequence, 0) == offset
        filled[sequence] = offset + length
    assert max(filled.values()) <= size and sorted(filled) == list(range(len(filled)))
    assert sum(r.length for r in rows) == sum(lengths)
    assert sum(1 for r in rows if r.piece == 0) == len(odd_corpus)
    assert len(filled) <= 1.05 * sum(lengths) / size


def test_two_pieces_take_the_place_of_one():
    # Greedy: 60 + 30 leaves 10 empty; 30 gives way to 22 and 18, which fill the sequence.
    assert packing.plan({60: 1, 30: 1, 22: 1, 18: 1}, 100)[0] == (1, [(60, 1), (22, 1), (18, 1)])
    for counts in ({1: 5}, {100: 3}, {51: 4}, {7: 1000, 13: 10, 99: 5}):
        fillings = packing.plan(counts, 100)
        packed = Counter()
        for times, used in fillings:
            assert sum(n * k for n, k in used) <= 100
            for n, k in used:
                packed[n] += times * k
        assert packed == counts


def test_packing_in_the_pipeline_leaves_no_words_behind(monkeypatch):
    """The workers of the pipeline serve the next stage: an encoder and its words end with the task."""
    path = vocabulary("word_bpe_49k.json")
    monkeypatch.setattr(packing, "TaskContext", type("Context", (), {"get": lambda: type("Task", (), {"partitionId": lambda self: 0})()}))
    batch = pa.record_batch({"doc_id": pa.array([1, 2], pa.int64()), "text": pa.array(["some words here", None])})
    plain, freed = (list(packing._cut(path, 4096, 1, 77, release)(iter([batch]))) for release in (False, True))
    assert plain == freed and packing.encoder.cache_info().currsize == 0
    taken = inspect.signature(packing.best_two_fit).parameters["release"].default
    assert taken is False and "release=True" in inspect.getsource(corpus_pipeline.packing)
