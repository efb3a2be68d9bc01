"""The weekly top-N visit ranking."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .anomaly import BASELINE_DAYS, METRICS, RECENT_DAYS, SIGMA, score_weeks

TOP_N = 15
MAX_REASON_CHARS = 300
# The scored weeks are eight Mondays from this one.
FIRST_SCORED_WEEK = date(2026, 2, 2)
SCORED_WEEK_COUNT = 8


def reason_text(
    score: Column,
    metric: Column,
    mode: str = "first_reading",
    baseline_days: int = BASELINE_DAYS,
    recent_days: int = RECENT_DAYS,
    sigma: float = SIGMA,
) -> Column:
    # The texts of the two reason modes.
    if mode == "first_breach":
        text = F.concat(
            score.cast("long").cast("string"),
            F.lit(
                f" hour(s) beyond {sigma:g} sigma of this gateway's own {baseline_days}-day baseline "
                f"in the last {recent_days} days; first breach on "
            ),
            F.when(metric != "", metric).otherwise(f"no metric over {sigma:g} sigma"),
        )
    else:
        text = F.when(
            metric != "",
            F.concat(
                score.cast("long").cast("string"),
                F.lit(f" anomalous hour(s) detected in the previous {recent_days} days based on "),
                metric,
                F.lit(f" exceeding the gateway's {baseline_days}-day baseline."),
            ),
        ).otherwise("Gateway ranked using recent telemetry anomaly score.")
    return F.substring(text, 1, MAX_REASON_CHARS)


def top_per_week(scores: DataFrame, n: int = TOP_N, key: str = "gateway_id") -> DataFrame:
    """Rank by score descending, then key. Spark cuts each map task to ``n`` rows per week first."""
    window = Window.partitionBy("week_start").orderBy(F.col("score").desc(), F.col(key).asc())
    return scores.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def rank_weeks(
    telemetry: DataFrame,
    weeks: Sequence[date],
    n: int = TOP_N,
    metrics: Sequence[str] = METRICS,
    baseline_days: int = BASELINE_DAYS,
    recent_days: int = RECENT_DAYS,
    sigma: float = SIGMA,
    key: str = "gateway_id",
    ts: str = "ts_utc",
    order: Sequence[str] = (),
    reason_mode: str = "first_reading",
    floor: float | None = None,
    measure: bool = False,
    derived: bool = False,
    moments: DataFrame | None = None,
) -> DataFrame:
    """``week_start, rank, gateway_id, score, reason`` for all weeks at once; see ``score_weeks``."""
    scores = score_weeks(
        telemetry,
        weeks,
        metrics,
        baseline_days,
        recent_days,
        sigma,
        key,
        ts,
        order,
        reason_mode,
        floor,
        measure,
        derived,
        moments,
    )
    reason = reason_text(F.col("score"), F.col("metric"), reason_mode, baseline_days, recent_days, sigma)
    return top_per_week(scores, n, key).select(
        F.date_format("week_start", "yyyy-MM-dd").alias("week_start"),
        "rank",
        F.col(key).alias("gateway_id"),
        F.col("score").cast("double").alias("score"),
        reason.alias("reason"),
    )


def require_full(ranking: DataFrame, weeks: Sequence[date], n: int = TOP_N) -> DataFrame:
    """Raise unless every week has ``n`` rows. Runs the ranking; pass a written one to save work."""
    asked = ranking.where(F.col("week_start").cast("string").isin([w.isoformat() for w in weeks]))
    found = {str(r["week_start"]): r["count"] for r in asked.groupBy("week_start").count().collect()}  # a row a week
    for week in weeks:
        have = found.get(week.isoformat(), 0)
        if have < n:
            raise ValueError(f"only {have} gateways have data before {week}, need {n}")
    return ranking
