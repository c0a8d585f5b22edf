"""Where plan modules register their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .domain import Tables, with_views

Job = Callable[[Tables], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, views: str = "", sql: str | None = None) -> Callable[[Job], Job]:
    """Register a job under ``name``; ``sql`` may use the listed domain views."""

    def wrap(job: Job) -> Job:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: job(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return job

    return wrap
