"""Session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "riskweave", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session used by tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_base: str | None = None


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate tables.

    The cluster names a shared folder in ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a temporary folder of its own.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="riskweave-")
        base = _local_base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
