"""Checks of a ranking table: ``check, week, ok, n_bad, detail``, one row per check and week."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import to_day
from ..functions.ids import canonical_id
from ..functions.numbers import to_number
from ..functions.text import strip
from ..schema import RANKING_COLUMNS
from .ranking import MAX_REASON_CHARS, TOP_N

RESULT = "check string, week string, ok boolean, n_bad bigint, detail string"


def _schema_checks(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in RANKING_COLUMNS if c not in columns]
    extra = [c for c in columns if c not in RANKING_COLUMNS]
    rows = [
        (name, None, not bad, len(bad), ", ".join(bad))
        for name, bad in (("missing_columns", missing), ("unexpected_columns", extra))
    ]
    return spark.createDataFrame(rows, RESULT)


def _stack(df: DataFrame, checks: Sequence[tuple[str, str, str, str]], week: str) -> DataFrame:
    """``checks`` holds (name, ok, n_bad, detail) as SQL over ``df``."""
    cells = ", ".join(f"'{n}', {ok}, cast({bad} as bigint), {detail}" for n, ok, bad, detail in checks)
    stacked = f"stack({len(checks)}, {cells}) as (check, ok, n_bad, detail)"
    return df.selectExpr(f"{week} as week", stacked).select("check", "week", "ok", "n_bad", "detail")


def validate(df: DataFrame, weeks: Sequence[date], n: int = TOP_N) -> DataFrame:
    """All checks, passed ones included. Missing columns end the checking; so does a week that is
    not a date, for the checks that need weeks."""
    spark = df.sparkSession
    columns = df.columns
    schema_checks = _schema_checks(spark, columns)
    if any(c not in columns for c in RANKING_COLUMNS):
        return schema_checks

    score_is_text = not isinstance(df.schema["score"].dataType, T.NumericType)
    reason = strip(F.col("reason").cast("string"))
    rows = df.select(
        to_day(df, "week_start").alias("week"),
        to_number(df, "rank").try_cast("bigint").alias("rank"),
        canonical_id(F.col("gateway_id")).alias("id"),
        F.coalesce(F.col("gateway_id").cast("string"), F.lit("null")).alias("raw_id"),
        to_number(df, "score").isNull().alias("score_unread"),
        (F.col("score").isNull() if score_is_text else to_number(df, "score").isNull()).alias("score_null"),
        reason.alias("reason"),
    )
    expected_rows = n * len(weeks)
    totals = rows.selectExpr("*", "id is null as bad_id").agg(
        F.count("*").alias("found"),
        F.expr("count_if(week is null)").alias("bad_weeks"),
        F.expr("count_if(bad_id)").alias("bad_ids"),
        F.expr("min(if(bad_id, raw_id, null))").alias("bad_example"),
        F.expr("count_if(score_unread and not score_null)").alias("score_text"),
        F.expr("count_if(score_null)").alias("score_blank"),
        F.expr("count_if(reason = '')").alias("blank"),
        F.expr("count_if(reason is null)").alias("absent"),
        F.expr(f"count_if(length(reason) > {MAX_REASON_CHARS})").alias("too_long"),
    )
    before_weeks = [
        (
            "row_count",
            f"found = {expected_rows}",
            f"abs(found - {expected_rows})",
            f"concat('expected {expected_rows} rows, found ', found)",
        ),
        ("week_start_is_date", "bad_weeks = 0", "bad_weeks", "''"),
    ]
    after_weeks = [
        ("gateway_id_form", "bad_ids = 0", "bad_ids", "coalesce(concat('e.g. ', bad_example), '')"),
        ("score_numeric", "score_text = 0", "score_text", "''"),
        (
            "score_blank",
            "score_blank = 0 or score_text > 0",
            "if(score_text > 0, 0, score_blank)",
            "''",
        ),
        ("reason_blank", "blank + absent = 0", "blank", "concat(absent, ' null')"),
        ("reason_length", "too_long = 0", "too_long", "''"),
    ]
    no_week = "cast(null as string)"
    dates_fine = totals.where("bad_weeks = 0")

    expected = spark.createDataFrame([(w,) for w in weeks], "week date").withColumn("is_expected", F.lit(True))
    per_week = rows.groupBy("week").agg(
        F.count("*").alias("found"),
        F.count("rank").alias("ranks"),
        F.count_distinct("rank").alias("distinct_ranks"),
        F.min("rank").alias("low"),
        F.max("rank").alias("high"),
        # invalid ids all compare equal, so they count as one
        F.count_distinct(F.coalesce("id", F.lit(""))).alias("ids"),
    )
    by_week = per_week.join(expected, "week", "full_outer").where(
        rows.agg(F.expr("count_if(week is null)")).scalar() == 0
    )
    presence = [
        ("week_expected", "is_expected is not null", "if(is_expected is null, 1, 0)", "''"),
        ("week_present", "found is not null", "if(found is null, 1, 0)", "''"),
    ]
    week_checks = [
        ("rows_per_week", f"found = {n}", f"abs(found - {n})", f"concat(found, ' rows, expected {n}')"),
        (
            "ranks",
            f"ranks = {n} and distinct_ranks = {n} and low = 1 and high = {n}",
            f"if(ranks = {n} and distinct_ranks = {n} and low = 1 and high = {n}, 0, 1)",
            f"'must be 1..{n} with no repeats'",
        ),
        ("gateway_repeated", "ids = found", "found - ids", "''"),
    ]
    week = "date_format(week, 'yyyy-MM-dd')"
    out = schema_checks.unionByName(_stack(totals, before_weeks, no_week))
    out = out.unionByName(_stack(dates_fine, after_weeks, no_week))
    out = out.unionByName(_stack(by_week, presence, week))
    return out.unionByName(_stack(by_week.where("found is not null"), week_checks, week))


def problems(checks: DataFrame) -> DataFrame:
    return checks.where("not ok")
