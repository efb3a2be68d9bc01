"""Formats taken from a column's first value; long lists of uneven weeks."""

from datetime import date, datetime, timedelta

import pytest

from gridwarden.functions.dates import first_format, format_of, to_day, to_utc
from gridwarden.operators import cleaning
from gridwarden.operators.anomaly import score_weeks
from gridwarden.operators.weeks import week_grid


@pytest.mark.parametrize(
    ("text", "pattern"),
    [
        ("2024-01-05", "yyyy-M-d"),
        ("20240105", "yyyyMMdd"),
        ("01/05/2024", "M/d/yyyy"),
        ("13/05/2024", "d/M/yyyy"),
        (" 5.1.2024 ", "M.d.yyyy"),
        ("5 Jan 2024 23:15", "d MMM yyyy H:mm"),
        ("2024/01/05 10:11:12.5", "yyyy/M/d H:mm:ss.SSSSSSSSS"),
        ("2024-01-05T10:11:12+02:00", "yyyy-M-d'T'H:mm:ssXXX"),
        ("1/5/2024 3:04 PM", "M/d/yyyy h:mm a"),
        ("soon", None),
        ("2024-01", None),
        ("2024-01-05 junk", None),
        ("2024-01/05", None),
    ],
)
def test_format_of(text, pattern):
    assert format_of(text) == pattern


def test_only_the_first_format_is_read(spark):
    rows = [(3, "05/13/2024 10:30"), (1, None), (2, " 4/5/2024 9:00"), (4, "2024-05-13 10:30"), (5, "13/05/2024 10:30"), (0, "  "), (6, "04/05/2024")]
    df = spark.createDataFrame(rows, "n int, t string")
    only = first_format(df, "t", ["n"])
    assert only == "M/d/yyyy H:mm"
    got = {r["n"]: (r["a"], r["b"]) for r in df.select("n", to_utc(df, "t", only=only).cast("timestamp_ntz").alias("a"), to_day(df, "t", only=only).alias("b")).collect()}
    assert got[2] == (datetime(2024, 4, 5, 9), date(2024, 4, 5)) and got[3] == (datetime(2024, 5, 13, 10, 30), date(2024, 5, 13))
    assert all(got[n] == (None, None) for n in (0, 1, 4, 5, 6))
    assert first_format(df.where("n > 100"), "t", ["n"]) is None and first_format(df, "n", ["n"]) is None


def test_the_day_stays_where_an_offset_moves_the_time(spark):
    df = spark.createDataFrame([("2024-01-05T23:30:00-05:00",)], "t string")
    row = df.select(to_day(df, "t", only=format_of("2024-01-05T23:30:00-05:00")).alias("d"), to_utc(df, "t", only="yyyy-M-d'T'H:mm:ssXXX").cast("timestamp_ntz").alias("u")).first()
    assert row["d"] == date(2024, 1, 5) and row["u"] == datetime(2024, 1, 6, 4, 30)


def test_telemetry_in_the_first_format(spark):
    rows = [("A" * 12, "01/02/2024 00:00", 1, "5"), ("A" * 12, "2024-01-03 00:00", 2, "6"), ("A" * 12, "12/31/2024 01:00", 3, "-7")]
    raw = spark.createDataFrame(rows, "gateway_id string, ts_utc string, n int, reboot_cnt string")
    out = cleaning.clean_telemetry(raw, ("n",), infer_format=True)
    assert sorted((r["reboot_cnt"]) for r in out.collect()) == [0.0, 5.0]
    assert cleaning.clean_telemetry(raw, ("n",)).count() == 1


def test_two_thousand_uneven_weeks(spark):
    start = datetime(2024, 1, 1)
    rows = [("A" * 12, start + timedelta(hours=6 * h), float(h * 7919 % 97), float(h % 9 == 0), None) for h in range(400)]
    schema = "gateway_id string, ts_utc timestamp_ntz, offline_duration_sec double, disconnection_cnt double, reboot_cnt double"
    tele = spark.createDataFrame(rows, schema)
    few = [date(2024, 1, 20) + timedelta(days=i * i % 71 + i) for i in range(30)]
    many = [date(2024, 1, 20) + timedelta(days=i + i % 3) for i in range(2000)]
    assert week_grid(few).as_table and not week_grid(few[:3]).as_table
    plan = lambda weeks: len(score_weeks(tele, weeks)._jdf.queryExecution().analyzed().toString())
    assert abs(plan(many) - plan(few)) < 2000
    got = score_weeks(tele, many, sigma=1.0).collect()
    found = {r["week_start"]: (r["score"], r["metric"]) for r in got}
    assert len(got) == len(found) == len({w for w in many if w - timedelta(days=7) <= rows[-1][1].date()})
    for week in (few[0], many[5], many[60]):
        (row,) = score_weeks(tele, [week], sigma=1.0).collect()
        assert week not in many or found[week] == (row["score"], row["metric"])
