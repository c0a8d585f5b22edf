"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint emits all variants within half the radius.  Two
fingerprints within the radius share a variant, namely one in the middle between
them, so a shuffle on variants brings them together.  All fingerprints of one
variant lie in a small ball around it: their number is bounded by the ball's size
however many documents there are, and they are pairwise within the radius, so
links to the smallest of them carry the whole component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import narrow, raw_texts, row_key, stored
from riskweave.llm.components import components

SEED = 42
_LANES = np.uint64(0x0101010101010101)
_SHIFTS = np.arange(8, dtype=np.uint64)[:, None]


def majority(hashes: np.ndarray) -> int:
    """64-bit number whose bits are those set in over half of the hashes.

    Bits are counted in byte lanes of 64-bit words, at most 255 hashes a lane.
    """
    if not len(hashes):
        return 0
    lanes = (hashes[None, :] >> _SHIFTS) & _LANES
    sums = np.add.reduceat(lanes, np.arange(0, len(hashes), 255), axis=1)
    counts = np.ascontiguousarray(sums).view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)
    return int.from_bytes(np.packbits((counts.T * 2 > len(hashes)).ravel(), bitorder="little").tobytes(), "little")


def fingerprint(text: bytes, words: int = 3) -> int:
    """Fingerprint of a text: A-Z lower-cased, ASCII white space between words, shingles of `words`."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-words] + 1])
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[words - 1 :].tolist(), strict=True)]
    return majority(np.array(hashes, np.uint64))


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(text, words) for text in raw_texts(batch.column("text"))], np.uint64)
            keys = [n for n in batch.schema.names if n != "text"]
            yield pa.record_batch([*(batch.column(n) for n in keys), pa.array(prints.view(np.int64))], names=[*keys, "fp"])

    return run


def ball(radius: int) -> list[int]:
    """Masks that turn a 64-bit number into every number within `radius` bits of it, as signed longs."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def _collisions(radius: int):
    """Sorted (variant, fp) rows -> verified links from the smallest fingerprint of a variant to its others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        variant, head = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("variant").to_numpy()
            prints = batch.column("fp").to_numpy()
            fresh = np.ones(len(keys), bool)
            fresh[1:] = keys[1:] != keys[:-1]
            fresh[0] = variant is None or keys[0] != variant
            place = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), -1))
            heads = np.where(place >= 0, prints[np.maximum(place, 0)], prints[0] if head is None else head)
            variant, head = keys[-1], heads[-1]
            near = (heads != prints) & (np.bitwise_count((heads ^ prints).view(np.uint64)) <= radius)
            yield pa.record_batch({"a": pa.array(prints[near]), "b": pa.array(heads[near])})

    return run


def near_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) that connect all within `radius` bits."""
    if radius < 0 or radius % 2:
        raise ValueError("the radius is even")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(radius // 2)])
    variants = prints.select("fp", F.explode(masks).alias("mask")).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"), "fp")
    together = variants.repartition("variant").sortWithinPartitions("variant", "fp")
    return together.mapInArrow(_collisions(radius), "a long, b long").distinct()


def _fp_components(prints: DataFrame, radius: int) -> DataFrame:
    """Distinct fingerprints (fp) -> (fp, component): those without a link are components of their own."""
    linked = components(near_links(prints, radius)).withColumnRenamed("node", "fp")
    return prints.join(linked, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: doc_id, fp (signed long), component_id (smallest reachable doc_id).

    A text of fewer than `words` words is one shingle; without words, and for null text, the
    fingerprint is zero and links like any other.  Repeated rows share a component.  Null ids
    are never the smallest; a component of null ids only has a null id.  An empty table gives
    an empty result; other columns are ignored.
    """
    marked = stored(narrow(docs, id_col, text_col).mapInArrow(_fingerprints(words), "doc_id long, fp long"), "fingerprints")
    prints = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    rooted = _fp_components(prints.select("fp"), radius).join(prints, "fp")
    least = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    named = rooted.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2) -> DataFrame:
    """The rows of `docs`, with all columns, that come first in their component: smallest id, null before all.

    Of rows that repeat an id the one whose text hashes least comes first; of rows that repeat
    both one is kept.
    """
    keys = row_key(docs, id_col, text_col)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    marked = stored(docs.select(*keys, text).mapInArrow(_fingerprints(words), "doc long, tie long, fp long"), "fingerprints")
    firsts = stored(marked.groupBy("fp").agg(F.min(F.struct("doc", "tie")).alias("least")), "prints")
    rooted = _fp_components(firsts.select("fp"), radius).join(firsts, "fp")
    stay = rooted.groupBy("component").agg(F.min("least").alias("first")).select("first.doc", "first.tie")
    wrapped = docs.select(F.struct("*").alias("row"), *keys)
    again = F.row_number().over(Window.partitionBy("doc", "tie").orderBy("doc"))
    kept = wrapped.join(stay, ["doc", "tie"], "left_semi")
    return kept.withColumn("again", again).filter("again = 1").select("row.*")
