"""What the plans must look like for the work to spread over a cluster."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from gridwarden.operators import anomaly
from gridwarden.operators.weeks import mondays
from gridwarden.plans.queries import all_queries
from gridwarden.sources import sample_tables

QUERIES = all_queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_joins_no_python_rows(spark, sample_dir, name):
    text = plan(QUERIES[name](spark, sample_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in text


def test_ranking_reads_what_it_needs(spark, sample_dir):
    text = plan(QUERIES["weekly_rank_3sigma"](spark, sample_dir))
    assert "props" not in re.findall(r"ReadSchema: (.*)", text)[0]
    pushed = re.findall(r"PushedFilters: (.*?\])", text)[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


@pytest.mark.parametrize("name", ["weekly_rank_3sigma", "weekly_rank_dirty", "hourly_flags"])
def test_deduplicated_rows_are_shuffled_once(spark, sample_dir, name):
    df = QUERIES[name](spark, sample_dir)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("FileScan") == 1


def test_unique_telemetry_is_not_shuffled(spark, sample_dir):
    """Measured thresholds are broadcast: scan, join and partial sums happen in one stage, and the
    scan is cut to the recent days."""
    text = plan(QUERIES["weekly_rank_first_breach"](spark, sample_dir))
    assert "BroadcastHashJoin" in text
    assert re.findall(r"GreaterThanOrEqual\(ts,([^)]*)\)", text)[-1] == "2024-01-01T00:00"
    joined = text.index("BroadcastHashJoin")
    assert text.rindex("Exchange hash", 0, joined) < text.rindex("partial_", 0, joined)
    assert "Exchange hash" not in text[joined:]


def test_top_rows_are_cut_before_the_shuffle(spark, sample_dir):
    text = plan(QUERIES["weekly_rank_3sigma"](spark, sample_dir))
    limits = [m.start() for m in re.finditer("WindowGroupLimit .*15, Partial", text)]
    assert len(limits) == 1 and text.rindex("Exchange", 0, limits[0]) < limits[0]


def busy_rows(spark, n=60_000):
    """One gateway with a third of all rows."""
    start = int(datetime(2026, 1, 5).timestamp())
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.format_string("G%04d", F.col("id") % 900)).alias("gateway_id"),
        F.timestamp_seconds(F.lit(start) + (F.col("id") * 39) % (28 * 86400)).cast("timestamp_ntz").alias("ts_utc"),
        F.when(F.col("id") % 501 == 0, F.lit(1e6)).otherwise(F.rand(3)).alias("offline_duration_sec"),
        F.lit(0).alias("disconnection_cnt"),
        F.lit(0).alias("reboot_cnt"),
    )


def salted(rows, week):
    grid = anomaly.week_grid(week)
    sql = f"WITH {anomaly._thresholds_sql(grid, 3, 3.0)}, {anomaly._hot_sql(3)} SELECT k, week_start, salt FROM salted"
    return anomaly._run(sql, anomaly.scoring_rows(rows, grid, anomaly.METRICS))


def test_a_busy_gateway_is_spread(spark, monkeypatch):
    """Its join partitions stay small, its score exact."""
    monkeypatch.setattr(anomaly, "SPLIT_ROWS", 1000)
    rows, week = busy_rows(spark), mondays(date(2026, 2, 2), 1)
    salts = salted(rows, week).where("k = 'HOT'").count()
    recent = rows.where("gateway_id = 'HOT' and ts_utc >= timestamp_ntz'2026-01-26'")
    shares = [r["count"] for r in recent.groupBy(F.expr(f"pmod(xxhash64(ts_utc), {salts})")).count().collect()]
    assert len(shares) == salts == 1 + sum(shares) // 1000 > 4 and max(shares) < 2 * min(shares)
    scored = {r["gateway_id"]: r["score"] for r in anomaly.score_weeks(rows, week).collect()}
    expected = recent.where("offline_duration_sec = 1e6").count()
    assert expected > 0 and scored["HOT"] == expected
    monkeypatch.setattr(anomaly, "SPLIT_ROWS", 1 << 40)
    assert {r["gateway_id"]: r["score"] for r in anomaly.score_weeks(rows, week).collect()} == scored


@pytest.mark.parametrize("partitions", ["4", "1000", "4096"])
def test_only_hot_thresholds_are_copied(spark, monkeypatch, partitions):
    """As many copies whatever the cluster's width: one a key and week, and the salts of hot ones."""
    monkeypatch.setattr(anomaly, "SPLIT_ROWS", 1000)
    rows, week = busy_rows(spark), mondays(date(2026, 2, 2), 1)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        copies = salted(rows, week)
        hot = rows.where("gateway_id = 'HOT' and ts_utc >= timestamp_ntz'2026-01-26'").count() // 1000
        assert hot >= 4 and copies.count() == copies.select("k", "week_start").distinct().count() + hot
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_distinct_counts_do_not_multiply_rows(spark, sample_dir):
    for name in ("dq_visits", "table_size"):
        assert "gid#" not in plan(QUERIES[name](spark, sample_dir))  # the mark of such an Expand


def test_sample_adapters_keep_every_row(spark, sample_dir):
    for adapter, table in ((sample_tables.telemetry, "events"), (sample_tables.meter_reads, "lineitem")):
        assert adapter(spark, sample_dir).count() == sample_tables.table(spark, sample_dir, table).count()
