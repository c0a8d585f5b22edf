"""Grouped risk analytics: rates by segment, pricing, cohorts, time of day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.arithmetic import mean, safe_divide, sum_where
from ..functions.cleaning import fill_text, upper_code
from .measures import SUCCESS_STATES, one_row, run_seconds

# Alert margins, report sizes and default assumptions.
ABOVE, BELOW = 1.15, 0.85
MIN_SEGMENT_CHURN, MIN_SEGMENT_FRAUD, MIN_SEGMENT_HEADLINE, MIN_COHORT = 50, 100, 200, 100
LOSS_GIVEN_DEFAULT = 0.6
REVIEW_SHARE, REVIEW_COST, CAPTURE_SHARE = 0.10, 15.0, 0.55
CONVERSION = 0.10
CHURN_DIMENSIONS = (
    "contract_type", "tenure_group", "internet_service", "payment_method", "paperless_billing", "tech_support",
    "online_security",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def segment_rate(
    df: DataFrame, segment: str, flag: str, value: str | None = None, min_n: int = 1
) -> DataFrame:
    """Per segment: share, size and number of flagged rows, and their value."""
    hit = F.col(flag) == 1
    aggs = [mean(flag).alias("rate"), F.count(F.lit(1)).alias("n"), F.sum(flag).alias("events")]
    if value:
        aggs.append(sum_where(hit, value).cast("decimal(38,2)").alias("value_lost"))
    out = df.where(F.col(segment).isNotNull()).groupBy(segment).agg(*aggs)
    return out.where(F.col("n") >= min_n) if min_n > 1 else out


def segment_rate_filled(
    df: DataFrame, segment: str, flag: str, value: str | None = None, min_n: int = MIN_SEGMENT_FRAUD
) -> DataFrame:
    """Segment rates with missing keys counted as "unknown"."""
    return segment_rate(df.withColumn(segment, fill_text(segment)), segment, flag, value, min_n)


def segment_vs_overall(df: DataFrame, segment: str, flag: str) -> DataFrame:
    """Segment rates tagged against the overall rate."""
    overall = df.agg(F.sum(flag).cast("double") / F.count(F.lit(1)).cast("double")).scalar()
    out = df.where(F.col(segment).isNotNull()).groupBy(segment).agg(F.count(F.lit(1)).alias("n"), F.sum(flag).alias("events"))
    out = out.withColumn("overall", overall)
    rate = F.col("events").cast("double") / F.col("n").cast("double")
    tag = (
        F.when(rate > F.col("overall") * ABOVE, F.lit("above"))
        .when(rate < F.col("overall") * BELOW, F.lit("below"))
        .otherwise(F.lit("near"))
    )
    return out.select(segment, "n", "events", rate.alias("rate"), "overall", tag.alias("tag"))


def rank_segments(
    df: DataFrame,
    dimensions: Sequence[str],
    flag: str,
    value: str,
    min_n: int = MIN_SEGMENT_CHURN,
    top: int = 10,
    yearly: int = 12,
) -> DataFrame:
    """The segments of several dimensions that lose most value.

    Rows are first folded to the combinations of the (low-cardinality)
    dimensions; only those few partial totals are then taken apart per dimension.
    """
    lost = F.col(flag) == 1
    base = df.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(flag).alias("events"),
        sum_where(lost, value).cast("decimal(38,2)").alias("value_lost"),
    )
    pairs = [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("segment")) for d in dimensions]
    stacked = base.select(F.explode(F.array(*pairs)).alias("s"), "n", "events", "value_lost").select("s.*", "n", "events", "value_lost")
    per = stacked.groupBy("dimension", "segment").agg(
        F.sum("n").alias("n"), F.sum("events").alias("events"), F.sum("value_lost").alias("value_lost")
    )
    # every dimension covers all rows, so the totals of one dimension give the overall rate
    one = Window.partitionBy("dimension")
    overall = F.sum("events").over(one).cast("double") / F.sum("n").over(one).cast("double")
    rate = F.col("events").cast("double") / F.col("n").cast("double")
    out = per.withColumn("overall", overall).where(F.col("segment").isNotNull() & (F.col("n") >= min_n))
    return (
        out.select(
            "dimension",
            "segment",
            F.col("n").alias("customers"),
            rate.alias("churn_rate"),
            (F.col("value_lost") * yearly).cast("decimal(38,2)").alias("annual_value_lost"),
            ((rate - F.col("overall")) * F.col("n").cast("double")).alias("excess_events"),
        )
        .orderBy(F.col("annual_value_lost").desc(), "dimension", "segment")
        .limit(top)
    )


def act_first(churn: DataFrame, loans: DataFrame, txns: DataFrame, runs: DataFrame) -> DataFrame:
    """One headline per domain."""

    def head(seg: DataFrame, domain: str, key: str, order: Sequence[Column], worth: Column) -> DataFrame:
        return seg.orderBy(*order, key).limit(1).select(
            F.lit(domain).alias("domain"), F.col(key).alias("segment"), F.col("rate"),
            F.col("n"), worth.cast("decimal(38,2)").alias("value_lost"),
        )

    most = F.col("value_lost").desc()
    failed = F.count_if(~_ok())
    health = runs.agg(
        F.lit("data_health").alias("domain"), F.lit("failed_runs").alias("segment"),
        safe_divide(failed, F.count(F.lit(1))).alias("rate"), failed.alias("n"),
        F.lit(0).cast("decimal(38,2)").alias("value_lost"),
    )
    return (
        head(segment_rate(churn, "contract_type", "churn_flag", "monthly_charges"), "churn", "contract_type",
             [most], F.col("value_lost") * 12)
        .unionByName(head(segment_rate(loans, "grade", "default_flag", "loan_amount"), "lending", "grade",
                          [most], F.col("value_lost")))
        .unionByName(head(segment_rate(txns, "email_domain", "is_fraud", min_n=MIN_SEGMENT_HEADLINE), "fraud",
                          "email_domain", [F.col("rate").desc()], F.lit(0)))
        .unionByName(health)
    )


def weighted_rate(df: DataFrame, flag: str, weight: str, name: str = "weighted_rate") -> DataFrame:
    return df.agg(safe_divide(sum_where(F.col(flag) == 1, weight), F.sum(weight), None).alias(name))


def group_compare(df: DataFrame, flag: str, value: str, median_of: str | None = None) -> DataFrame:
    """Mean of a value in both groups, and the exact median of another column in the flagged one."""
    from .ordered import exact_quantiles

    means = df.agg(
        mean(F.when(F.col(flag) == 1, F.col(value))).alias("mean_flagged"),
        mean(F.when(F.col(flag) == 0, F.col(value))).alias("mean_other"),
    )
    if median_of is None:
        return means
    median = exact_quantiles(df.where(F.col(flag) == 1), [median_of], [0.5]).select(F.col("value").alias("median_flagged"))
    return one_row(means, median)


def revenue_lost_share(df: DataFrame, flag: str, monthly: str) -> DataFrame:
    total = (F.sum(monthly) * 12).cast("decimal(38,2)")
    lost = (sum_where(F.col(flag) == 1, monthly) * 12).cast("decimal(38,2)")
    return df.agg(
        total.alias("annual_revenue"), lost.alias("annual_revenue_lost"), safe_divide(lost, total).alias("lost_share")
    )


def price_vs_loss(df: DataFrame, lgd: float = LOSS_GIVEN_DEFAULT) -> DataFrame:
    """Per grade: is the interest rate (percent) above the expected credit loss?"""
    grades = df.where(F.col("grade").isNotNull()).groupBy("grade").agg(
        mean("interest_rate").alias("avg_rate"), mean("default_flag").alias("default_rate"),
        F.count(F.lit(1)).alias("n"),
    )
    grades = grades.withColumn("expected_loss", F.col("default_rate") * lgd * 100.0)
    grades = grades.withColumn("margin_pts", F.col("avg_rate") - F.col("expected_loss"))
    widest = Window.partitionBy(F.lit(0)).orderBy(F.col("margin_pts").desc(), "grade")
    return grades.select(
        "*", (F.col("margin_pts") < 0).alias("underpriced"), (F.row_number().over(widest) == 1).alias("widest_margin")
    )


def vintage_rate(df: DataFrame, date: str, flag: str, min_n: int = MIN_COHORT) -> DataFrame:
    quarter = F.trunc(date, "quarter").alias("vintage")
    out = df.where(F.col(date).isNotNull()).groupBy(quarter).agg(mean(flag).alias("rate"), F.count(F.lit(1)).alias("n"))
    return out.where(F.col("n") >= min_n)


def concentration(df: DataFrame, segment: str, value: str) -> DataFrame:
    """Sum per segment and its share of the whole."""
    known = df.where(F.col(segment).isNotNull())
    sums = known.groupBy(segment).agg(F.sum(value).cast("decimal(38,2)").alias("total"))
    whole = known.agg(F.sum(value).cast("decimal(38,2)")).scalar()
    return sums.select(segment, "total", safe_divide("total", whole, None).alias("share"))


def rate_heatmap(df: DataFrame, ts: str, flag: str) -> DataFrame:
    """Weekday x hour rates, Monday first; hours without rows are null."""
    day = F.weekday(ts)
    cells = df.where(F.col(ts).isNotNull()).groupBy(day.alias("day_no"), F.hour(ts).alias("hour")).agg(
        F.sum(flag).alias("events"), F.count(flag).alias("n")
    )
    rate = F.try_divide(F.sum("events").cast("double"), F.sum("n").cast("double"))
    wide = cells.groupBy("day_no").pivot("hour", list(range(24))).agg(rate)
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    return wide.select(
        "day_no", F.element_at(names, (F.col("day_no") + 1).cast("int")).alias("day_name"),
        *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)],
    ).orderBy("day_no")


def peak_hour(df: DataFrame, ts: str, flag: str) -> DataFrame:
    """Hour with the highest rate (the earliest on a tie); overnight and day rates."""
    hours = df.where(F.col(ts).isNotNull()).groupBy(F.hour(ts).alias("hour")).agg(
        F.sum(flag).alias("events"), F.count(flag).alias("n")
    )
    rate = F.try_divide(F.col("events").cast("double"), F.col("n").cast("double"))

    def part(cond: Column) -> Column:
        return F.try_divide(
            F.sum(F.when(cond, F.col("events"))).cast("double"), F.sum(F.when(cond, F.col("n"))).cast("double")
        )

    return hours.agg(
        F.max_by("hour", F.struct(rate.alias("r"), (-F.col("hour")).alias("h"))).alias("peak_hour"),
        F.max(rate).alias("peak_rate"),
        part(F.col("hour") < 6).alias("overnight_rate"),
        part(F.col("hour") >= 6).alias("day_rate"),
    )


def _ok() -> Column:
    return F.coalesce(upper_code("status").isin(*SUCCESS_STATES), F.lit(False))


def daily_run_health(runs: DataFrame) -> DataFrame:
    """Per start day: runs, success rate, mean minutes; incomplete days dropped."""
    minutes = F.try_divide(mean(run_seconds()), F.lit(60000.0))
    out = runs.where(F.col("started_at").isNotNull()).groupBy(F.to_date("started_at").alias("day")).agg(
        F.count(F.lit(1)).alias("runs"), mean(_ok().cast("int")).alias("success"), minutes.alias("minutes")
    )
    return out.where(F.col("minutes").isNotNull())


def failure_rate_by_table(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("target_table").isNotNull()).groupBy("target_table").agg(
        F.count(F.lit(1)).alias("runs"), (F.lit(1.0) - mean(_ok().cast("int"))).alias("failure_rate")
    )


def review_benefit(
    df: DataFrame, flag: str, amount: str, capture: float = CAPTURE_SHARE, cost: float = REVIEW_COST
) -> DataFrame:
    """Value of reviewing a tenth of all rows at a cost each."""
    rows = F.count(F.lit(1)).cast("double")
    saved = sum_where(F.col(flag) == 1, amount).cast("double") * capture
    return df.agg(
        (rows * REVIEW_SHARE).alias("reviews"), saved.alias("fraud_prevented"),
        (saved - rows * REVIEW_SHARE * cost).alias("net_benefit"),
    )


def retention_what_if(df: DataFrame, conversion: float = CONVERSION) -> DataFrame:
    """What moving a share of month-to-month customers to a contract would keep."""
    monthly = F.col("contract_type") == "Month-to-month"
    flag = F.col("churn_flag")
    stats = df.agg(
        F.count_if(monthly).cast("double").alias("n"),
        mean(F.when(monthly, flag)).alias("short_rate"),
        mean(F.when(~monthly, flag)).alias("long_rate"),
        mean(F.when(monthly, F.col("monthly_charges"))).alias("charge"),
    )
    gap = F.col("short_rate") - F.col("long_rate")
    stats = stats.select("*", gap.alias("gap"), (F.col("n") * conversion * F.greatest(gap, F.lit(0.0))).alias("kept"))
    return stats.select(
        "gap", F.col("kept").alias("customers_retained"), (F.col("kept") * F.col("charge") * 12.0).alias("annual_revenue")
    )


def report_matrix(df: DataFrame, rows: Sequence[str], values: Mapping[str, str]) -> DataFrame:
    """Row totals of several columns: ``values`` maps a column to its sql type."""
    return df.groupBy(*rows).agg(*[F.sum(c).cast(t).alias(c) for c, t in values.items()])


def report_detail(df: DataFrame, columns: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """Distinct tuples of the shown columns."""
    out = df.select(*columns).distinct()
    return out.orderBy(*order) if order else out


def calendar(bounds: DataFrame, first: str = "first", last: str = "last") -> DataFrame:
    """One row per day between the dates of a one-row frame, with calendar parts.

    Weeks start on Monday and week 1 holds 1 January.
    """
    d = F.col("date")
    days = bounds.select(F.explode(F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))).alias("date"))
    week = F.floor((F.dayofyear(d) + F.weekday(F.trunc(d, "year")) - 1) / F.lit(7)) + 1
    return days.select(
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("weekday"),
        week.cast("int").alias("week_of_year"),
        F.concat(F.year(d).cast("string"), F.lit(" Q"), F.quarter(d).cast("string")).alias("year_quarter"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        (F.weekday(d) >= 5).alias("is_weekend"),
        F.lit(False).alias("is_holiday"),
    )


def newest(df: DataFrame, ts: str, id_: str, n: int) -> DataFrame:
    """Newest rows first (top-k, never a full sort)."""
    return df.orderBy(F.col(ts).desc(), F.col(id_).desc()).limit(n)


def top_alerts(df: DataFrame, flag: Column, amount: str, id_: str, n: int) -> DataFrame:
    return df.where(flag).orderBy(F.col(amount).desc(), id_).limit(n)


def recent_failures(runs: DataFrame, n: int = 15) -> DataFrame:
    shown = ["run_id", "started_at", "task_id", "target_table", "records_failed", "error_message"]
    return runs.where(~_ok()).orderBy(F.col("started_at").desc(), "run_id").limit(n).select(*shown)


def retention_call_list(df: DataFrame, n: int = 25) -> DataFrame:
    """Active customers by expected yearly loss."""
    expected = F.col("churn_probability") * F.col("monthly_charges").cast("double") * 12.0
    listed = df.where(F.col("churn_flag") == 0).withColumn("expected_loss", expected)
    return listed.orderBy(F.col("expected_loss").desc_nulls_last(), "customer_id").limit(n).select(
        "customer_id", "contract_type", "tenure", "monthly_charges", "churn_probability", "expected_loss"
    )
