"""Scoring, batch scoring and the prediction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import mean
from ..functions.rules import Scorecard
from ..functions.validation import Rule, validate_rows
from ..sources.committed import append_committed

HISTOGRAM_BINS = 20


def score_rules(df: DataFrame, card: Scorecard) -> DataFrame:
    """Add the scorecard's probability, label and drivers."""
    scored = df.withColumn("probability", F.round(card.probability(), 4))
    return scored.select(
        "*", card.label(F.col("probability")).alias("prediction"), card.drivers().alias("top_drivers"),
        F.lit(card.model).alias("model"), F.lit(card.version).alias("model_version"), F.lit(True).alias("fallback"),
    )


def score_with_fallback(df: DataFrame, card: Scorecard, model_score: str, threshold: float, model: str, version: str) -> DataFrame:
    """The model's score where there is one, the scorecard's elsewhere."""
    have = F.col(model_score).isNotNull()
    p = F.coalesce(F.col(model_score), card.probability())
    limit = F.when(have, F.lit(threshold)).otherwise(F.lit(0.5))
    return df.select(
        "*", p.alias("probability"), card.label(p, limit).alias("prediction"),
        F.when(have, F.lit(model)).otherwise(F.lit(card.model)).alias("model"),
        F.when(have, F.lit(version)).otherwise(F.lit(card.version)).alias("model_version"),
        (~have).alias("fallback"),
    )


def score_model(
    model, df: DataFrame, card: Scorecard, threshold: float, name: str, version: str, features: Sequence[str] = ()
) -> DataFrame:
    """Probability of a fitted pipeline, label at its stored threshold.

    The first five features are reported as drivers."""
    out = model.transform(df)
    p = vector_to_array("probability")[1]
    keep = [c for c in df.columns if c != "probability"]
    return out.select(
        *keep, F.round(p, 4).alias("probability"), card.label(p, threshold).alias("prediction"),
        F.array(*[F.lit(f) for f in features[:5]]).cast("array<string>").alias("top_drivers"),
        F.lit(name).alias("model"), F.lit(version).alias("model_version"), F.lit(False).alias("fallback"),
    )


def score_what_if(df: DataFrame, card: Scorecard, column: str, value: str) -> DataFrame:
    """Probability now, with one field changed, and the difference."""
    now = df.withColumn("probability_now", F.round(card.probability(), 4))
    changed = now.withColumn("_kept", F.col(column)).withColumn(column, F.lit(value))
    changed = changed.withColumn("probability_if", F.round(card.probability(), 4)).withColumn(column, F.col("_kept"))
    delta = F.round((F.col("probability_now") - F.col("probability_if")).cast("decimal(20,10)"), 4).cast("double")
    return changed.drop("_kept").withColumn("change", delta)


def score_batch(df: DataFrame, card: Scorecard, rules: Sequence[Rule]) -> DataFrame:
    """Score every row of a file: bad rows keep their place with a null score and the errors."""
    checked = validate_rows(df, rules)
    typed = checked.select(
        *[F.col(r.field).try_cast(r.type_).alias(r.field) if r.field in df.columns else F.lit(None).cast(r.type_).alias(r.field)
          for r in rules],
        *[c for c in checked.columns if c not in {r.field for r in rules}],
    )
    good = F.size("errors") == 0
    p = F.when(good, F.round(card.probability(), 4))
    return typed.withColumn("probability", p).withColumn(
        "prediction", F.when(good, card.label(F.col("probability")))
    )


def batch_summary(scored: DataFrame) -> DataFrame:
    ok = F.count("probability")
    return scored.agg(
        F.count(F.lit(1)).alias("total"), ok.alias("success"), (F.count(F.lit(1)) - ok).alias("failed"),
        mean("probability").alias("mean_probability"),
    )


def score_histogram(df: DataFrame, probability: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Rows per equal-width bin of [0, 1]; 1.0 belongs to the last bin."""
    slot = F.least(F.floor(F.col(probability) * bins) + 1, F.lit(bins)).cast("int")
    return df.where(F.col(probability).isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def leaderboard(candidates: DataFrame, name: str, metric: str) -> DataFrame:
    """Candidates by metric, the winner marked (one row per candidate model)."""
    order = Window.partitionBy(F.lit(0)).orderBy(F.col(metric).desc_nulls_last(), name)
    return candidates.withColumn("place", F.row_number().over(order)).withColumn("selected", F.col("place") == 1)


def prediction_log(scored: DataFrame, task: str, inference_ms: Column, at: Column) -> DataFrame:
    """Rows for the monitoring table; drivers as JSON text."""
    return scored.select(
        F.lit(task).alias("task"), F.col("model").alias("model_name"), "model_version",
        F.col("prediction").alias("prediction_label"), F.col("probability").alias("prediction_score"),
        F.to_json("top_drivers").alias("top_drivers"), inference_ms.cast("int").alias("inference_ms"), "fallback",
        at.alias("created_at"),
    )


def log_predictions(rows: DataFrame, table: str, run: str, batch: int | str = 0) -> bool:
    """Appends rows of `prediction_log` to the monitoring table as one batch of a run; a batch counts once however often it is sent."""
    return append_committed(rows, table, run, batch)
