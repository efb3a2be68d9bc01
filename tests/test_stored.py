"""Stored moments against full runs."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridwarden.operators import ranking, stored
from gridwarden.operators.anomaly import score_weeks
from gridwarden.operators.weeks import mondays

WEEKS = mondays(date(2024, 2, 5), 3)
SCHEMA = "gateway_id string, ts_utc timestamp_ntz, offline_duration_sec double, disconnection_cnt double, reboot_cnt double, n int"


@pytest.fixture(scope="module")
def readings(spark):
    start = datetime(2024, 1, 1)
    rows = [
        (f"{g:012X}", start + timedelta(hours=h), float((h * 7919 + g * 104729) % 97), float(h % 40 == 0) * 9, None, 0)
        for g in range(6)
        for h in range(0, 24 * 56, 3)
    ]
    rows += [(r[0], r[1], 10_000.0, 5.0, 1.0, 1) for r in rows[::50]]  # copies that come later and don't count
    return spark.createDataFrame(rows, SCHEMA)


def scores(df):
    return sorted((r["gateway_id"], r["week_start"], r["score"], r["metric"]) for r in df.collect())


@pytest.mark.parametrize("measure", [False, True])
def test_next_week_equals_the_full_run(spark, readings, tmp_path, measure):
    path = str(tmp_path / "moments")
    stored.write_moments(readings, path, order=("n",))
    for weeks in ([WEEKS[0]], WEEKS):
        got = score_weeks(readings, weeks, sigma=1.0, order=("n",), measure=measure, moments=stored.read_moments(spark, path))
        want = score_weeks(readings, weeks, sigma=1.0, order=("n",))
        assert scores(got) == scores(want) and sum(r[2] for r in scores(want)) > 0


def test_a_week_reads_its_recent_days_only(spark, readings, tmp_path):
    readings.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    stored.write_moments(raw, str(tmp_path / "moments"))
    week = WEEKS[1]
    old = raw.where(F.col("ts_utc") < F.lit(week - timedelta(days=7)).cast("timestamp_ntz"))
    recent = raw.exceptAll(old)
    moments = stored.read_moments(spark, str(tmp_path / "moments"))
    # without the older rows the result is the same, so they aren't read
    assert scores(score_weeks(recent, [week], sigma=1.0, moments=moments)) == scores(score_weeks(raw, [week], sigma=1.0))
    plan = score_weeks(raw, [week], moments=moments)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts_utc,2024-02-05T00:00" in plan and "stored_bucket" in plan.split("PartitionFilters: [")[1]


def test_late_rows_replace_their_buckets(spark, readings, tmp_path):
    path = str(tmp_path / "moments")
    late = F.col("ts_utc").between(datetime(2024, 1, 16), datetime(2024, 1, 18))
    stored.write_moments(readings.where(~late), path, order=("n",))
    before = {p.name: [f.stat().st_mtime_ns for f in p.glob("*.parquet")] for p in (tmp_path / "moments").glob("stored_*")}
    moments = lambda: stored.read_moments(spark, path)
    full = score_weeks(readings, WEEKS, sigma=1.0, order=("n",))
    assert stored.add_late_rows(readings, readings.where(late), path, order=("n",)) == [date(2024, 1, 15)]
    assert scores(score_weeks(readings, WEEKS, sigma=1.0, order=("n",), moments=moments())) == scores(full)
    after = {p.name: [f.stat().st_mtime_ns for f in p.glob("*.parquet")] for p in (tmp_path / "moments").glob("stored_*")}
    assert {n for n in after if after[n] != before.get(n)} == {"stored_bucket=2024-01-15"}
    # a bucket whose rows are all gone goes too
    stored.write_moments(readings.where("ts_utc < '2024-01-15' or ts_utc >= '2024-01-22'"), path, only=[date(2024, 1, 15)])
    assert moments().where("stored_bucket = '2024-01-15'").isEmpty() and not moments().isEmpty()
    assert stored.add_late_rows(readings, readings.limit(0), path) == []


def test_windows_that_cut_buckets_are_refused(spark, readings, tmp_path):
    stored.write_moments(readings, str(tmp_path / "m"))
    moments = stored.read_moments(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError, match="whole|stored buckets"):
        score_weeks(readings, WEEKS, baseline_days=21, recent_days=3, moments=moments)
    with pytest.raises(ValueError, match="stored buckets"):
        ranking.rank_weeks(readings, [date(2024, 2, 6)], moments=moments)
