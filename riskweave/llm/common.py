"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import work_dir

#: Stands for a null id inside numpy code; it sorts before every real id, as nulls do in Spark.
NO_ID = np.iinfo(np.int64).min
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of tables stored on the way to a result that is to be settled, innermost last.
_noted: list[list[str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends here."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, name)
    for paths in _noted:
        paths.append(path)
    with freed(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more."""
    for t in tables:
        _delete(t.sparkSession, t.stored_at)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """What `make` returns, stored; all that it stored on the way is deleted."""
    _noted.append([])
    try:
        out = stored(make(), name)
    finally:
        paths = _noted.pop()
    for path in paths:
        if path != out.stored_at:
            _delete(out.sparkSession, path)
    return out


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names, whatever else the table holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, null as empty."""
    return [b"" if v is None else v for v in column.cast(pa.binary()).to_pylist()]


def id_array(column: pa.Array) -> np.ndarray:
    return column.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False)


def ids_to_arrow(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, pa.int64(), mask=ids == NO_ID)


def remainder(id_col: str, modulus: int) -> F.Column:
    """crc32 of the id as text, modulo `modulus`; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def batches_by_bytes(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a slice holds about `most` bytes of one column, one row at least."""
    for batch in batches:
        sizes = batch.column(column).cast(pa.binary())
        lengths = np.diff(np.frombuffer(sizes.buffers()[1], np.int32)[sizes.offset : sizes.offset + len(sizes) + 1]) if len(sizes) else np.zeros(0, np.int64)
        for start, end in runs(lengths, most):
            yield batch.slice(start, end - start)


def runs(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Begins and ends of runs of rows whose lengths add up to about `most`, of one row at least."""
    marks = np.cumsum(lengths, dtype=np.int64) // most
    begins = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]])).tolist() if len(marks) else []
    yield from zip(begins, [*begins[1:], len(marks)], strict=False)


def row_key(docs: DataFrame, id_col: str, text_col: str) -> tuple[F.Column, F.Column]:
    """Columns doc and tie that tell rows apart: the id, null as the smallest, and a hash of the text.

    Where no id repeats, the second is 0.
    """
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID)))
    repeated = bool(docs.select(doc.alias("doc")).groupBy("doc").count().filter("count > 1").head(1))
    tie = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))) if repeated else F.lit(0).cast("long")
    return doc.alias("doc"), tie.alias("tie")
