import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.sources import audited_write, read_csv, read_gzip_csv, read_model_metadata, read_table, replace_partitions, write_table

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.DoubleType())])


def test_permissive_csv_keeps_bad_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.5\nx,3.0\n2,\n")
    got = read_csv(spark, str(tmp_path / "a.csv"), SCHEMA, keep_corrupt=True).collect()
    assert [(r["id"], r["v"], r["_corrupt"]) for r in got] == [(1, 2.5, None), (None, 3.0, "x,3.0"), (2, None, None)]


def test_csv_reads_only_the_wanted_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,2.5\n")
    df = read_csv(spark, str(tmp_path / "a.csv"), SCHEMA, columns=["v"])
    assert "ReadSchema: struct<v:double>" in df._jdf.queryExecution().executedPlan().toString()


def test_gzip(spark, tmp_path):
    import gzip

    with gzip.open(tmp_path / "a.csv.gz", "wt") as f:
        f.write("id,v\n1,2.5\n2,3.5\n")
    assert read_gzip_csv(spark, str(tmp_path / "a.csv.gz"), SCHEMA).agg(F.sum("v")).first()[0] == 6.0


def test_daily_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_partitions(spark.createDataFrame([(1, "d1"), (2, "d2")], "id int, ds string"), path, "ds")
    replace_partitions(spark.createDataFrame([(3, "d2")], "id int, ds string"), path, "ds")
    assert sorted((r["id"], r["ds"]) for r in read_table(spark, path).collect()) == [(1, "d1"), (3, "d2")]


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    for mode in ("overwrite", "append", "overwrite", "append"):
        write_table(spark.range(3), path, mode)
    assert read_table(spark, path).count() == 6


def test_audit_of_good_and_failed_loads(spark, tmp_path):
    log = str(tmp_path / "audit")
    df = spark.range(10)
    audited_write(df, str(tmp_path / "a"), log, dag="d", task="t", source="s", bad=F.col("id") > 7)
    assert read_table(spark, str(tmp_path / "a")).count() == 8
    broken = df.select(F.raise_error(F.lit("boom")).cast("string").alias("x"))
    with pytest.raises(Exception, match="boom"):
        audited_write(broken, str(tmp_path / "b"), log, dag="d", task="t", source="s")
    got = {r["status"]: r for r in read_table(spark, log).collect()}
    assert (got["SUCCESS"]["records_read"], got["SUCCESS"]["records_written"], got["SUCCESS"]["records_failed"]) == (10, 8, 2)
    assert "boom" in got["FAILED"]["error_message"]


def test_model_metadata(spark, tmp_path):
    doc = {"name": "m", "task": "churn", "algorithm": "lr", "version": "2", "threshold": 0.32, "features": ["a", "b"], "target": "y",
           "metrics": {"accuracy": 0.76, "precision": 0.5, "recall": 0.7, "f1": 0.6, "roc_auc": 0.8391, "training_seconds": 0.6}}
    (tmp_path / "churn_metadata.json").write_text(json.dumps(doc, indent=2))
    row = read_model_metadata(spark, str(tmp_path / "*_metadata.json")).first()
    assert float(row["roc_auc"]) == 0.8391 and row["features"] == '["a","b"]' and float(row["f1_score"]) == 0.6
