"""Appends are seen whole and once."""

import pytest
from pyspark.sql import functions as F

from riskweave.sources import committed as C

KIND = "id long, score double"


def rows(spark, lo, hi):
    return spark.range(lo, hi).select("id", (F.col("id") / 10).alias("score"))


def test_a_retried_append_leaves_one_copy(spark, tmp_path):
    table = str(tmp_path / "log")
    assert C.read_committed(spark, table, KIND).count() == 0
    assert C.append_committed(rows(spark, 0, 10), table, "monday", 0)
    assert not C.append_committed(rows(spark, 0, 10), table, "monday", 0)
    assert C.append_committed(rows(spark, 10, 15), table, "monday", 1)
    # another run may use the same batch numbers
    assert C.append_committed(rows(spark, 15, 20), table, "tuesday", 0)
    got = C.read_committed(spark, table, KIND)
    assert sorted(r["id"] for r in got.collect()) == list(range(20))
    assert {(r["run_id"], r["batch"]): r["count"] for r in got.groupBy("run_id", "batch").count().collect()} == {("monday", "0"): 10, ("monday", "1"): 5, ("tuesday", "0"): 5}


def test_a_failed_append_leaves_none(spark, tmp_path):
    table = str(tmp_path / "log")
    C.append_committed(rows(spark, 0, 5), table, "run")
    broken = rows(spark, 5, 2000).repartition(4).select("id", F.when(F.col("id") == 1999, F.raise_error("lost").cast("double")).otherwise(F.col("score")).alias("score"))
    with pytest.raises(Exception, match="lost"):
        C.append_committed(broken, table, "run", 1)
    assert C.read_committed(spark, table, KIND).count() == 5
    assert C.append_committed(rows(spark, 5, 8), table, "run", 1)  # sent again
    assert C.read_committed(spark, table, KIND).count() == 8


def test_of_two_racing_attempts_one_wins(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "log")
    C.append_committed(rows(spark, 0, 4), table, "run")
    seen = iter([False, True])
    monkeypatch.setattr(C, "is_committed", lambda *a: next(seen))  # the first look came too early
    assert not C.append_committed(rows(spark, 0, 4), table, "run")
    monkeypatch.undo()
    assert C.read_committed(spark, table, KIND).count() == 4


def test_run_ids_are_file_names(spark, tmp_path):
    for run in ("", "a/b", "_x", "a~b"):
        with pytest.raises(ValueError):
            C.append_committed(rows(spark, 0, 1), str(tmp_path / "log"), run)
