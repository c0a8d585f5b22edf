"""Readers over Spark's own connectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import CORRUPT


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | None = None,
    columns: Sequence[str] | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """CSV with header in permissive mode.

    With a schema, bad rows keep their text in ``_corrupt`` when asked for.
    Without one the types are inferred, at the price of a second pass.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    elif keep_corrupt:
        wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        df = reader.option("columnNameOfCorruptRecord", CORRUPT).schema(wide).csv(path)
    else:
        df = reader.schema(schema).csv(path)
    return df.select(*columns) if columns else df


def read_gzip_csv(
    spark: SparkSession, path: str, schema: T.StructType, partitions: int | None = None
) -> DataFrame:
    """Gzip files cannot be split: one task reads one file, then rows are spread.

    Without a number of partitions adaptive execution sizes them."""
    df = read_csv(spark, path, schema)
    return df.repartition(partitions) if partitions else df.hint("rebalance")


def read_table(
    spark: SparkSession,
    name: str,
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """A warehouse table: a path of a file format, or a JDBC table.

    For JDBC, ``split_on`` with ``bounds`` reads in parallel ranges.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        reader = reader.option("dbtable", name)
        if split_on and bounds:
            reader = reader.options(
                partitionColumn=split_on, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
            )
        df = reader.load()
    else:
        df = reader.load(name)
    return df.select(*columns) if columns else df


def read_model_metadata(spark: SparkSession, glob: str) -> DataFrame:
    """Training records from nested JSON documents, one per file."""
    raw = spark.read.option("multiLine", True).json(glob)

    def metric(name: str, alias: str | None = None):
        return F.col(f"metrics.{name}").cast("decimal(6,4)").alias(alias or name)

    return raw.select(
        F.col("name").alias("model_name"), "task", "algorithm", "version",
        metric("accuracy"), metric("precision", "precision_score"), metric("recall", "recall_score"),
        metric("f1", "f1_score"), metric("roc_auc"),
        F.col("threshold").cast("decimal(6,4)").alias("threshold"),
        F.col("metrics.training_seconds").cast("decimal(8,2)").alias("training_seconds"),
        F.to_json("features").alias("features"), "target",
    )


def read_json_messages(spark: SparkSession, path: str, stream: bool = False, per_trigger: int | None = None) -> DataFrame:
    """Message payloads as one text column ``data``: a batch, or a stream of files."""
    if not stream:
        return spark.read.text(path).withColumnRenamed("value", "data")
    reader = spark.readStream
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.text(path).withColumnRenamed("value", "data")
