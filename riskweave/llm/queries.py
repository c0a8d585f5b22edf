"""The registered queries of this subpackage, next to the SQL that checks them."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import remainder, table
from riskweave.llm.exact_dedup import content_sort_dedup
from riskweave.llm.hmm_lm import hmm_scores, with_held_out
from riskweave.llm.kd_shards import kd_shards
from riskweave.llm.line_dedup import near_lines
from riskweave.llm.maxscore import top_k
from riskweave.llm.merge_dropout import decode, encode
from riskweave.llm.packing import best_two_fit
from riskweave.llm.quality import fit_quality, quality_scores
from riskweave.llm.repair import damage, repair
from riskweave.llm.shallot import shallot_clusters
from riskweave.llm.simhash import simhash_components
from riskweave.llm.suffix_dedup import remove_repeats
from riskweave.llm.toxicity import fit_toxicity, toxicity_scores

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_lines(table(spark, sf_dir, "documents"), similarity=0.8).drop("tie", "copy")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = content_sort_dedup(table(spark, sf_dir, "documents"), keep="largest")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP2_SQL = f"""
WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g USING (norm)
"""


def _held_out(found: DataFrame) -> DataFrame:
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), lambda c: remainder(c, 5) != 0)
    return _held_out(quality_scores(docs, model, at=0.3))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"), lambda c: remainder(c, 5) != 0)
    return _held_out(toxicity_scores(docs, model, at=0.5))


def op4_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column("ids"), [batch.column(c).cast(pa.binary()) for c in ("text", "decoded")]
        arrays = [v.values.to_numpy().astype("<u4") for v in ids]
        yield pa.record_batch(
            {
                "doc_id": batch.column("doc_id"),
                "n_ids": pa.array([len(a) for a in arrays], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(a.tobytes()) for a in arrays], pa.int64()),
                "decoded_crc32": pa.array([zlib.crc32(v.as_py()) for v in texts[1]], pa.int64()),
                "lossless": pa.array([a.as_py() == b.as_py() for a, b in zip(*texts, strict=True)], pa.bool_()),
            }
        )


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = vocabulary("piece_bpe_32k.model")
    pieces = decode(encode(table(spark, sf_dir, "documents"), path, rate=0.1, seed=17), path)
    return pieces.mapInArrow(_digests, "doc_id long, n_ids long, ids_crc32 long, decoded_crc32 long, lossless boolean")


def op5_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm_scores(with_held_out(table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2))


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_two_fit(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), size=4096, end_id=1)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), threshold=100)
    return found.select("rest.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"), words=3, radius=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair(damage(table(spark, sf_dir, "conversations")), lost_col="lost")
    lines = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    return found.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256")
    )


# the least cost row by row over the places in the pattern, with up to two insertions before each row and at the end
_NEXT = "CASE {q} WHEN 2 THEN 3 ELSE 2 END"
_ADDED = f"[CASE {_NEXT.format(q='q')} WHEN 2 THEN 'user:' ELSE 'assistant:' END, CASE {_NEXT.format(q='q')} WHEN 2 THEN 'assistant:' ELSE 'user:' END]"
_INSERTED = f"""SELECT conv_id, i, m, CASE m WHEN 0 THEN q WHEN 1 THEN {_NEXT.format(q='q')} ELSE 5 - {_NEXT.format(q='q')} END AS q,
  cost + 5*m AS cost, audit || repeat('I', m) AS audit, rep || ({_ADDED})[1:m] AS rep FROM {{of}}, (SELECT unnest(range(3)) AS m)"""
OP11_SQL = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda n: list_reduce([CAST(n AS UBIGINT)] || [CAST(0 AS UBIGINT) FOR z IN range(8)],
  lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS UBIGINT)) ELSE a >> 1 END)) AS t),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS UBIGINT)) AS bytes FROM conversations),
h AS (SELECT k.*, xor(list_reduce([CAST(4294967295 AS UBIGINT)] || bytes, lambda a, c: xor(a >> 8, t[1 + CAST(xor(a, c) & 255 AS BIGINT)])), CAST(4294967295 AS UBIGINT)) % 20 AS kind FROM k, crc),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM h, (SELECT unnest(range(2)) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS MATERIALIZED (SELECT *, role[1:1] AS ini, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS prev, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank'
   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
   WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault FROM p),
s AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, CAST(0 AS BIGINT) AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS rep FROM conversations
 UNION ALL
 SELECT conv_id, i, q, min(cost), arg_min(audit, (cost, audit)), arg_min(rep, (cost, audit)) FROM (
  SELECT n.conv_id, n.i + 1 AS i, CASE e WHEN 'D' THEN n.q WHEN 'K' THEN CASE WHEN ini = 's' THEN 1 ELSE {_NEXT.format(q='n.q')} END ELSE {_NEXT.format(q='n.q')} END AS q,
   n.cost + CASE e WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END + CASE WHEN e <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END AS cost, n.audit || e AS audit,
   CASE e WHEN 'D' THEN n.rep WHEN 'K' THEN n.rep || [role || ':' || text] ELSE n.rep || [CASE WHEN n.q = 2 THEN 'assistant:' ELSE 'user:' END || text] END AS rep
  FROM ({_INSERTED.format(of='s')}) n JOIN f ON f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.i = n.i + 1, (SELECT unnest(['D', 'K', 'R']) AS e)
  WHERE e = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (e = 'R' OR (ini = 's' AND n.q = 0) OR (ini = 'u' AND n.q <> 2) OR (ini = 'a' AND n.q = 2)))
 ) GROUP BY conv_id, i, q),
c AS (SELECT DISTINCT conv_id FROM conversations),
g AS (SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
  count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
  count(*) FILTER (WHERE f.i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(f.i) AS n
  FROM c LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id)
SELECT g.conv_id, gaps, blank, duplicate, truncated, illegal, min(e.cost) AS cost, arg_min(e.audit, (e.cost, e.audit)) AS audit,
 sha256(array_to_string(arg_min(e.rep, (e.cost, e.audit)), chr(10))) AS repaired_sha256
FROM g JOIN ({_INSERTED.format(of='s')}) e ON e.conv_id IS NOT DISTINCT FROM g.conv_id AND e.i = g.n AND e.q IN (0, 3) GROUP BY ALL
"""


def op12_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(table(spark, sf_dir, "documents"), shards=40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op13_shallot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot_clusters(table(spark, sf_dir, "embeddings"), k=8, rounds=10, scale=1024.0, components=64, seed="3").withColumn(
        "centroid_sha256", F.sha2("centroid", 256)
    ).drop("centroid")


def _op13_sql(rounds: int = 10) -> str:
    """Lloyd rounds one after the other, all distances taken."""
    gap = "list_sum([(v.x[i] - c.x[i]) * (v.x[i] - c.x[i]) FOR i IN range(1, 65)])"
    parts = [
        """v AS MATERIALIZED (SELECT vec_id, [CAST(floor(1024 * e::DOUBLE) AS BIGINT) FOR e IN embedding] AS x FROM embeddings
 WHERE len(embedding) = 64 AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0)""",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS j, x FROM v QUALIFY j < 8)",
    ]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(x) AS x, arg_min(j, (d, j)) AS cluster, min(d) AS distance
 FROM (SELECT v.vec_id, v.x, c.j, CAST({gap} AS BIGINT) AS d FROM v, c{r} c) GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""m{r} AS (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM (
 SELECT cluster, i, sum(e)::HUGEINT AS s, count(*) AS n FROM (SELECT cluster, unnest(x) AS e, unnest(range(1, 65)) AS i FROM a{r}) GROUP BY cluster, i) GROUP BY cluster)""")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT j, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m ON m.cluster = c.j)")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
 CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} c ON c.j = cluster"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_maxscore": op4_maxscore,
    "op5_hmm_lm": op5_hmm_lm,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_toxicity": op8_toxicity,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_simhash": op10_simhash,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_kd_shards": op12_kd_shards,
    "op13_shallot": op13_shallot,
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op4_maxscore": OP4_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op13_shallot": _op13_sql(),
}
