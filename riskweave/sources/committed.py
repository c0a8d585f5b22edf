"""Tables that grow by committed appends: a run's batch is seen whole and once, or not at all.

Rows go to a folder of their own attempt.  A small manifest, named after run and batch and put in place by
one rename that never replaces, makes them part of the table.  An attempt that dies leaves no manifest,
so readers do not see it; a batch that is appended again finds its manifest and writes nothing; of two
that race, one rename wins.  The store must rename files atomically (HDFS and local disks do).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _files(spark: SparkSession, path: str):
    jvm = spark._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location, jvm.org.apache.hadoop.fs.Path


def _manifest(table: str, run: str, batch: int | str) -> str:
    if not run or run.startswith((".", "_")) or set(run) & set("/~:%"):
        raise ValueError("a run id is a plain file name")
    return f"{table.rstrip('/')}/manifests/{run}~{batch}.json"


def is_committed(spark: SparkSession, table: str, run: str, batch: int | str = 0) -> bool:
    files, place, _ = _files(spark, _manifest(table, run, batch))
    return files.exists(place)


def append_committed(df: DataFrame, table: str, run: str, batch: int | str = 0) -> bool:
    """Appends the rows as `batch` of `run`; false, and nothing is written, if that batch is in the table already."""
    spark = df.sparkSession
    goal = _manifest(table, run, batch)
    if is_committed(spark, table, run, batch):
        return False
    attempt = f"{table.rstrip('/')}/attempts/{run}~{batch}~{uuid.uuid4().hex[:12]}"
    df.write.parquet(attempt)
    files, place, path = _files(spark, goal)
    files.mkdirs(place.getParent())
    draft = path(f"{table.rstrip('/')}/drafts/{uuid.uuid4().hex}.json")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({"run": run, "batch": str(batch), "attempt": attempt.rsplit("/", 1)[1]}).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    try:
        context.rename(draft, place, spark._sc._gateway.new_array(rename, 0))
    except Exception:
        if is_committed(spark, table, run, batch):  # another attempt was first
            files.delete(draft, False)
            return False
        raise
    return True


def committed_attempts(spark: SparkSession, table: str) -> list[dict]:
    """Manifests of the table: one entry a batch, in order of run and batch."""
    files, place, _ = _files(spark, f"{table.rstrip('/')}/manifests")
    if not files.exists(place) or not files.listStatus(place):
        return []
    rows = spark.read.text(place.toString(), wholetext=True).collect()
    return sorted((json.loads(r["value"]) for r in rows), key=lambda m: (m["run"], m["batch"]))


def read_committed(spark: SparkSession, table: str, schema: T.StructType | str) -> DataFrame:
    """The rows of all committed batches, with `run_id` and `batch` beside them; an empty frame before the first."""
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    folders = [f"{table.rstrip('/')}/attempts/{m['attempt']}" for m in committed_attempts(spark, table)]
    if not folders:
        return spark.createDataFrame([], T.StructType([*kind.fields, T.StructField("run_id", T.StringType()), T.StructField("batch", T.StringType())]))
    folder = F.split(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2), "~")
    return spark.read.schema(kind).parquet(*folders).select("*", folder[0].alias("run_id"), folder[1].alias("batch"))
