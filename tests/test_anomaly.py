import random
from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridwarden.operators import anomaly, ranking
from gridwarden.operators.weeks import mondays, week_grid

MONDAY = date(2026, 2, 2)
M = datetime(2026, 2, 2)
HOUR = timedelta(hours=1)
SCHEMA = "gateway_id string, ts_utc timestamp_ntz, offline_duration_sec double, disconnection_cnt int, reboot_cnt int"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def steady(gateway, start, hours, values=(1.0, 1, 1), jitter=1):
    """Hourly rows that alternate by ``jitter`` so that the deviation is not 0."""
    return [
        (gateway, start + HOUR * i, values[0] + jitter * (i % 2), values[1] + jitter * (i % 2), values[2] + jitter * (i % 2))
        for i in range(hours)
    ]


def scores(df, weeks=(MONDAY,), **options):
    return {
        (r["week_start"].isoformat(), r["gateway_id"]): (r["score"], r["metric"])
        for r in anomaly.score_weeks(df, list(weeks), **options).collect()
    }


def brute_force(rows, weeks, baseline_days=28, recent_days=7, sigma=3.0, first_breach=False):
    """The definition, week by week, on a small pandas frame."""
    pdf = pd.DataFrame(rows, columns=["g", "ts", *anomaly.METRICS])
    found = {}
    for week in weeks:
        end = pd.Timestamp(week)
        window = pdf[(pdf.ts >= end - pd.Timedelta(days=baseline_days)) & (pdf.ts < end)]
        for g, own in window.groupby("g"):
            recent = own[own.ts >= end - pd.Timedelta(days=recent_days)].sort_values("ts")
            if recent.empty:
                continue
            score, names = 0, []
            limits = {}
            for m in anomaly.METRICS:
                values = own[m].dropna()
                if len(values) > 1 and values.min() < values.max():
                    limits[m] = values.mean() + sigma * values.std()
            for _, row in recent.iterrows():
                hits = [m for m in anomaly.METRICS if m in limits and row[m] > limits[m]]
                score += len(hits)
                names.append(hits[0] if hits else "")
            metric = next((n for n in names if n), "") if first_breach else names[0]
            found[(week.isoformat(), g)] = (score, metric)
    return found


def random_rows(seed, gateways=6, days=60, step_hours=5):
    rng = random.Random(seed)
    rows = []
    for g in range(gateways):
        t = M - timedelta(days=35) + timedelta(minutes=rng.randrange(600))
        while t < M + timedelta(days=days - 35):
            if rng.random() < 0.8:
                spike = rng.random() < 0.06
                rows.append(
                    (
                        f"{g:012X}",
                        t,
                        None if rng.random() < 0.03 else (rng.random() * (60 if spike else 5) if g else 0.1),
                        rng.choice([0, 0, 0, 1]) + (9 if spike else 0),
                        (4 if rng.random() < 0.02 else 0),
                    )
                )
            t += timedelta(hours=step_hours) if g != 5 else timedelta(hours=step_hours, days=rng.choice([0, 0, 9]))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "options",
    [
        {},
        {"sigma": 1.0},
        {"reason_mode": "first_breach"},
        {"baseline_days": 20, "recent_days": 3, "sigma": 2.0},
        {"baseline_days": 14, "recent_days": 14, "reason_mode": "first_breach", "sigma": 1.5},
        {"floor": 0.0, "sigma": 1.0},
        {"floor": 0.0, "reason_mode": "first_breach"},
        {"measure": True, "sigma": 1.5},
        {"measure": True, "floor": 0.0, "reason_mode": "first_breach", "sigma": 1.0},
    ],
)
def test_against_the_definition(spark, seed, options):
    rows = random_rows(seed)
    weeks = [*mondays(MONDAY, 3), date(2026, 3, 25)]
    first_breach = options.get("reason_mode") == "first_breach"
    plain = {k: v for k, v in options.items() if k in ("sigma", "baseline_days", "recent_days")}
    expected = brute_force(rows, weeks, first_breach=first_breach, **plain)
    assert scores(frame(spark, rows).repartition(5), weeks, **options) == expected


def test_many_thresholds_are_not_broadcast(spark, monkeypatch):
    df = frame(spark, random_rows(3))
    expected = scores(df, sigma=1.0)
    few = anomaly.score_weeks(df, [MONDAY], sigma=1.0, measure=True)
    assert "BroadcastHashJoin" in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(anomaly, "BROADCAST_BYTES", 100)
    many = anomaly.score_weeks(df, [MONDAY], sigma=1.0, measure=True)
    assert "ShuffledHashJoin" in many._jdf.queryExecution().executedPlan().toString()
    assert scores(df, sigma=1.0, measure=True) == expected == scores(df, sigma=1.0, measure=True, floor=0.0)


def test_window_edges(spark):
    """The baseline includes the recent days; both windows are half-open."""
    edges = {
        "in_baseline": M - timedelta(days=28),
        "too_old": M - timedelta(days=28, seconds=1),
        "recent": M - timedelta(days=7),
        "not_recent": M - timedelta(days=7, seconds=1),
        "too_new": M,
    }
    rows = [(name, ts, 1.0, 0, 0) for name, ts in edges.items()]
    stats = anomaly.baseline_stats(frame(spark, rows), [MONDAY]).collect()
    assert {r["gateway_id"] for r in stats} == {"in_baseline", "recent", "not_recent"}
    assert set(scores(frame(spark, rows))) == {("2026-02-02", "recent")}


def test_one_hour_counts_once_per_metric(spark):
    rows = steady("A", M - timedelta(days=20), 24 * 20 - 1) + [("A", M - HOUR, 1.0, 90, 90)]
    assert scores(frame(spark, rows)) == {("2026-02-02", "A"): (2, "")}
    assert scores(frame(spark, rows), reason_mode="first_breach") == {("2026-02-02", "A"): (2, "disconnection_cnt")}


def test_reason_is_the_first_metric_in_declared_order_of_the_first_reading(spark):
    start = M - timedelta(days=7)
    rows = steady("A", M - timedelta(days=20), 24 * 13) + [("A", start, 1.0, 9, 900)] + steady("A", start + HOUR, 100)
    assert scores(frame(spark, rows))[("2026-02-02", "A")] == (2, "disconnection_cnt")


def test_constant_and_single_readings_are_never_flagged(spark):
    """A constant such as 0.1 has no deviation even when its partial sums are off in the last bit."""
    rows = [("const", M - HOUR * i, 0.1, 7, 3) for i in range(1, 600)] + [("single", M - HOUR, 5.0, 1, 1)]
    found = scores(frame(spark, rows).repartition(7), sigma=0.0)
    assert found == {("2026-02-02", "const"): (0, ""), ("2026-02-02", "single"): (0, "")}
    stats = {r["gateway_id"]: r for r in anomaly.baseline_stats(frame(spark, rows).repartition(7), [MONDAY]).collect()}
    assert stats["const"]["std_offline_duration_sec"] == 0.0
    assert stats["const"]["mean_offline_duration_sec"] == 0.1
    assert stats["single"]["std_offline_duration_sec"] is None


def test_equality_is_not_a_breach(spark):
    """Readings 0 (9 times) and 10: mean 1, squared deviation 90/9 = 10, so 10 = 1 + s * sqrt(10)."""
    rows = [("A", M - HOUR * (i + 2), 0.0, 0, 0) for i in range(9)] + [("A", M - HOUR, 0.0, 4, 0)]
    # disconnections: 0 x 9 and 4 -> mean 0.4, std = sqrt((9*0.16 + 12.96)/9) = sqrt(1.6)
    assert scores(frame(spark, rows), sigma=3.6 / 1.6**0.5)[("2026-02-02", "A")][0] == 0
    assert scores(frame(spark, rows), sigma=2.8)[("2026-02-02", "A")][0] == 1


def test_silent_gateways_are_not_ranked_and_zero_scores_are(spark):
    rows = steady("silent", M - timedelta(days=27), 24 * 19) + steady("quiet", M - timedelta(days=6), 24)
    assert scores(frame(spark, rows)) == {("2026-02-02", "quiet"): (0, "")}
    out = ranking.rank_weeks(frame(spark, rows), [MONDAY]).collect()
    assert [tuple(r) for r in out] == [
        ("2026-02-02", 1, "quiet", 0.0, "Gateway ranked using recent telemetry anomaly score.")
    ]


def test_nan_counts_as_missing(spark):
    rows = steady("A", M - timedelta(days=20), 400) + [("A", M - HOUR, float("nan"), 1, 1), ("A", M - 2 * HOUR, 99.0, 1, 1)]
    assert scores(frame(spark, rows))[("2026-02-02", "A")][0] == 1


def test_duplicates_keep_the_first_by_order(spark):
    rows = [(*r, i) for i, r in enumerate(steady("A", M - timedelta(days=20), 24 * 20 - 1))]
    rows += [("A", M - HOUR, 1.0, 1, 1, 10_000), ("A", M - HOUR, 999.0, 99, 99, 10_001)]
    df = frame(spark, rows, SCHEMA + ", o int")
    assert scores(df, order=["o"])[("2026-02-02", "A")][0] == 0
    flagged = anomaly.flag_rows(df, [MONDAY], order=["o"])
    assert flagged.count() == 24 * 7


def test_ties_rank_by_id_and_the_cut_is_exact(spark):
    rows = [r for g in ("C", "A", "B", "D") for r in steady(g, M - timedelta(days=6), 30)]
    out = ranking.rank_weeks(frame(spark, rows).repartition(4), [MONDAY], n=3).orderBy("rank").collect()
    assert [(r["rank"], r["gateway_id"]) for r in out] == [(1, "A"), (2, "B"), (3, "C")]
    with pytest.raises(ValueError, match="only 4 gateways"):
        ranking.require_full(ranking.rank_weeks(frame(spark, rows), [MONDAY]), [MONDAY])


def test_weeks_can_be_asked_for_one_at_a_time(spark):
    rows = [r for g in "ABC" for r in steady(g, M - timedelta(days=6), 24 * 60)]
    weeks = mondays(MONDAY, 8)
    ranked = ranking.rank_weeks(frame(spark, rows), weeks, n=3).checkpoint()
    for week in weeks:
        ranking.require_full(ranked, [week], 3)
    with pytest.raises(ValueError, match="only 0 gateways"):
        ranking.require_full(ranked, [date(2020, 1, 6)], 3)


def test_reason_texts(spark):
    df = spark.createDataFrame([(19, "disconnection_cnt"), (0, "")], "s bigint, m string")
    texts = [tuple(r) for r in df.select(
        ranking.reason_text(F.col("s"), F.col("m")), ranking.reason_text(F.col("s"), F.col("m"), "first_breach")
    ).collect()]
    assert texts[0] == (
        "19 anomalous hour(s) detected in the previous 7 days based on disconnection_cnt exceeding the gateway's 28-day baseline.",
        "19 hour(s) beyond 3 sigma of this gateway's own 28-day baseline in the last 7 days; first breach on disconnection_cnt",
    )
    assert texts[1][0] == "Gateway ranked using recent telemetry anomaly score."
    assert texts[1][1].endswith("first breach on no metric over 3 sigma")
    long = spark.range(1).select(ranking.reason_text(F.lit(1), F.lit("x" * 400))).first()[0]
    assert len(long) == 300


def test_a_wrong_floor_is_noticed(spark):
    rows = [("A", M - HOUR * i, -50.0 - i % 2, 1, 1) for i in range(1, 50)]
    with pytest.raises(Exception, match="below the declared floor"):
        scores(frame(spark, rows), floor=0.0)


def test_same_result_for_any_partitioning(spark):
    rows = random_rows(7)
    df = frame(spark, rows)
    expected = scores(df)
    for partitions in ("1", "30"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            assert scores(df.repartition(int(partitions))) == expected
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_grid():
    grid = week_grid(mondays(MONDAY, 8))
    assert (grid.bucket_days, len(grid.baseline)) == (7, 11)
    assert [len(w) for w in grid.baseline] == [1, 2, 3, 4, 4, 4, 4, 4, 3, 2, 1]
    assert sum(len(w) for w in grid.recent) == 8
    assert week_grid([MONDAY], 28, 3).bucket_days == 1
    with pytest.raises(ValueError):
        week_grid([MONDAY], 7, 28)
    with pytest.raises(ValueError):
        week_grid([])


def test_zoned_times_need_utc(spark):
    df = frame(spark, steady("A", M - timedelta(days=6), 30)).withColumn("ts_utc", F.col("ts_utc").cast("timestamp"))
    assert scores(df) == {("2026-02-02", "A"): (0, "")}
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            scores(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
