from datetime import date

import pytest
from pyspark.sql import functions as F

from gridwarden.operators.validate import problems, validate
from gridwarden.operators.weeks import mondays

WEEKS = mondays(date(2026, 2, 2), 2)
N = 3


def good(spark):
    data = [(w.isoformat(), r, f"0A000000000{r}", float(10 - r), "because") for w in WEEKS for r in range(1, N + 1)]
    return spark.createDataFrame(data, "week_start string, rank int, gateway_id string, score double, reason string")


def at(rank, week=0):
    return (F.col("week_start") == WEEKS[week].isoformat()) & (F.col("rank") == rank)


def found(df):
    return sorted((r["check"], r["week"], r["n_bad"]) for r in problems(validate(df, WEEKS, N)).collect())


def changed(df, column, value, rank=1, week=0):
    return df.withColumn(column, F.when(~at(rank, week), F.col(column)).otherwise(value))


def test_good(spark):
    result = validate(good(spark), WEEKS, N)
    assert found(good(spark)) == []
    assert {r["check"] for r in result.collect()} == {
        "missing_columns", "unexpected_columns", "row_count", "week_start_is_date", "gateway_id_form", "score_numeric",
        "score_blank", "reason_blank", "reason_length", "week_expected", "week_present", "rows_per_week", "ranks",
        "gateway_repeated",
    }
    colons = changed(good(spark), "gateway_id", F.lit("0a:00:00:00:00:01"))
    assert found(colons) == []


W1, W2 = (w.isoformat() for w in WEEKS)


@pytest.mark.parametrize(
    ("change", "expected"),
    [
        (lambda d: d.drop("score"), [("missing_columns", None, 1)]),
        (lambda d: d.withColumn("x", F.lit(1)), [("unexpected_columns", None, 1)]),
        (lambda d: d.where(~at(3)), [("ranks", W1, 1), ("row_count", None, 1), ("rows_per_week", W1, 2 - 1)]),
        (lambda d: changed(d, "week_start", F.lit("soon")), [("week_start_is_date", None, 1)]),
        (
            lambda d: d.withColumn("week_start", F.when(F.col("week_start") == W2, "2026-03-02").otherwise(F.col("week_start"))),
            [("week_expected", "2026-03-02", 1), ("week_present", W2, 1)],
        ),
        (lambda d: changed(d, "gateway_id", F.lit("xyz")), [("gateway_id_form", None, 1)]),
        (lambda d: changed(d, "score", F.lit(None)), [("score_blank", None, 1)]),
        (lambda d: changed(d.withColumn("score", F.col("score").cast("string")), "score", F.lit("high")), [("score_numeric", None, 1)]),
        (lambda d: changed(d, "reason", F.lit(" \t")), [("reason_blank", None, 1)]),
        (lambda d: changed(d, "reason", F.lit(None)), [("reason_blank", None, 0)]),
        (lambda d: changed(d, "reason", F.repeat(F.lit("x"), 301)), [("reason_length", None, 1)]),
        (lambda d: changed(d, "reason", F.concat(F.repeat(F.lit("x"), 300), F.lit("  "))), []),
        (lambda d: changed(d, "rank", F.lit(2)), [("ranks", W1, 1)]),
        (lambda d: changed(d, "gateway_id", F.lit("0a:00:00:00:00:02")), [("gateway_repeated", W1, 1)]),
        (
            lambda d: changed(changed(d, "gateway_id", F.lit("x")), "gateway_id", F.lit("y"), rank=2),
            [("gateway_id_form", None, 2), ("gateway_repeated", W1, 1)],
        ),
        (lambda d: changed(d.withColumn("rank", F.col("rank").cast("string")), "rank", F.lit("1.0")), []),
    ],
)
def test_each_defect(spark, change, expected):
    assert found(change(good(spark))) == expected


def test_a_bad_week_ends_the_later_checks(spark):
    bad = changed(changed(good(spark), "gateway_id", F.lit("xyz")), "week_start", F.lit("soon"))
    assert found(bad) == [("week_start_is_date", None, 1)]
    assert {r["check"] for r in validate(bad, WEEKS, N).collect()} == {
        "missing_columns", "unexpected_columns", "row_count", "week_start_is_date",
    }
