"""Inputs that the sample tables do not hold: odd dates, ties without order, files that disagree."""

from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridwarden.functions.dates import to_day, to_utc
from gridwarden.operators.dedup import keep_by_key
from gridwarden.operators.labels import table_size
from gridwarden.operators.validate import validate
from gridwarden.operators.weeks import grid_months, mondays
from gridwarden.plans.flow import quality_report
from gridwarden.sources import readers


@pytest.mark.parametrize(
    ("text", "day", "time"),
    [
        ("2026-01-05", date(2026, 1, 5), datetime(2026, 1, 5)),
        (" 2026-1-5 ", date(2026, 1, 5), datetime(2026, 1, 5)),
        ("2026-01-05T10:00:00Z", date(2026, 1, 5), datetime(2026, 1, 5, 10)),
        ("2026-01-05 23:30:00-02:00", date(2026, 1, 5), datetime(2026, 1, 6, 1, 30)),
        ("2026-01-05 junk", None, None),
        ("2026-01-05 9 lives", None, None),
        ("2026-01", None, None),
        ("2026-1", None, None),
        ("2026", None, None),
        ("12:30", None, None),
        ("T10:00", None, None),
        ("2026-02-30", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_dates_are_whole(spark, text, day, time):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(to_day(df, "t").alias("d"), to_utc(df, "t").cast("timestamp_ntz").alias("u")).first()
    assert (row["d"], row["u"]) == (day, time)


def test_a_junk_week_is_a_problem(spark):
    rows = [("2026-02-02 xx", 1, "0A0000000001", 1.0, "r")]
    df = spark.createDataFrame(rows, "week_start string, rank int, gateway_id string, score double, reason string")
    found = {r["check"]: r["ok"] for r in validate(df, [date(2026, 2, 2)], 1).collect()}
    assert found["week_start_is_date"] is False


@pytest.mark.parametrize("keep", ["first", "last"])
@pytest.mark.parametrize("kind", ["int", "double", "date", "timestamp", "boolean"])
def test_a_null_order_comes_first_in_either_form(spark, keep, kind):
    values = {"int": "5", "double": "5.5", "date": "date'2026-01-01'", "timestamp": "timestamp'2026-01-01'", "boolean": "false"}
    df = spark.sql(f"SELECT * FROM VALUES ('A', {values[kind]}, 1), ('A', null, 2), ('B', null, 7) AS t(k, o, v)")
    hashed = {tuple(r) for r in keep_by_key(df, ["k"], ["o"], keep).collect()}
    ranked = keep_by_key(df.withColumn("w", F.lit("text")), ["k"], ["o"], keep).drop("w")
    assert hashed == {tuple(r) for r in ranked.collect()}
    assert {(k, v) for k, _, v in hashed} == {("A", 2 if keep == "first" else 1), ("B", 7)}


@pytest.fixture
def drifting(tmp_path):
    """Four files: counts as whole numbers, as floats, with one more column, and with one less."""
    base = {"gateway_id": ["0A0000000001"] * 2, "ts_utc": ["2026-01-05 00:00:00", "2026-01-05 01:00:00"]}
    full = base | {"offline_duration_sec": [1.0, 2.0], "disconnection_cnt": [1, 0]}
    files = {
        "2026-01/part-0": full | {"reboot_cnt": [3, 4]},
        "2026-01/part-1": full | {"reboot_cnt": [5.5, None]},
        "2026-02/part-0": full | {"reboot_cnt": [6, 7], "firmware": ["a", None]},
        "2026-02/part-1": full,
    }
    for name, columns in files.items():
        path = tmp_path / "telemetry" / f"month={name}.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        pd.DataFrame(columns).to_parquet(path, index=False)
    return tmp_path


def test_files_that_disagree(spark, drifting):
    df = readers.read_telemetry(spark, f"{drifting}/telemetry", with_order=True, with_path=True)
    assert dict(df.dtypes)["reboot_cnt"] == "double"
    assert sorted(r["reboot_cnt"] or -1 for r in df.collect()) == [-1, -1, -1, 3, 4, 5.5, 6, 7]
    assert df.where("firmware = 'a'").count() == 1 and df.select("_file").distinct().count() == 4
    pruned = readers.read_telemetry(spark, f"{drifting}/telemetry", columns=["gateway_id", "reboot_cnt"], months=["2026-02"])
    assert pruned.columns == ["gateway_id", "reboot_cnt"] and pruned.count() == 4


def test_each_file_is_profiled_by_its_own_columns(spark, drifting):
    report = {(r["scope"][-22:], r["check"]): r["value"] for r in quality_report(spark, str(drifting)).collect()}
    def found(check):
        return [report.get((f"2026-0{m}/part-{p}.parquet", check)) for m in (1, 2) for p in (0, 1)]
    assert found("columns") == ["5", "5", "6", "4"]
    assert found("missing_values") == ["0", "1", "1", "0"]
    assert found("missing_required_columns") == ["", "", "", "reboot_cnt"]
    assert found("negative_reboot_cnt") == ["0", "0", "0", None]
    assert (report["all", "rows"], report["all", "duplicate_gateway_timestamps"], report["all", "unique_gateways"]) == ("8", "6", "1")


def test_report_without_telemetry(spark, tmp_path):
    pd.DataFrame({"gateway_id": ["A"], "Kategorie": ["gut"], "reviewed_on": ["x"]}).to_csv(tmp_path / "engineer_reviews.csv", index=False)
    report = quality_report(spark, str(tmp_path)).collect()
    assert {r["table"] for r in report} == {"telemetry", "engineer_reviews"}
    assert [r["value"] for r in report if r["table"] == "telemetry"] == ["0"]


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "field_visits.csv"
    path.write_bytes("visit_id,gateway_id,note\r\nv1,A,\"one\ntwo, \"\"three\"\"\"\r\nv2,B,plain\r\nv3,C,\"x\r\ny\"\r\n".encode("utf-8-sig"))
    rows = readers.load_file(spark, str(path), with_order=True).orderBy(*readers.CSV_ORDER).collect()
    assert [r["visit_id"] for r in rows] == ["v1", "v2", "v3"]
    assert rows[0]["note"] == 'one\ntwo, "three"' and rows[2]["note"].split() == ["x", "y"]
    master = tmp_path / "gateway_master.csv"
    master.write_bytes("gateway_id,site\nA,\"Süd\n€\"\nB,Nord\n".encode("cp1252"))
    assert [r["site"] for r in readers.read_gateway_master(spark, str(master)).orderBy("gateway_id").collect()] == ["Süd\n€", "Nord"]


@pytest.mark.parametrize("names", [("2025-11", "2026-01"), ("202511", "202601"), ("11", "1"), ("november", "january")])
def test_months_prune_whole_folders(spark, tmp_path, names):
    for i, name in enumerate(names):
        folder = tmp_path / f"month={name}"
        folder.mkdir()
        pd.DataFrame({"gateway_id": [str(i)]}).to_parquet(folder / "part-0.parquet", index=False)
    months = grid_months([date(2026, 2, 2)], 7)
    assert months == ["2025-12", "2026-01", "2026-02", "2026-03"]
    df = readers.read_telemetry(spark, str(tmp_path), months=months)
    assert "PartitionFilters: []" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == (2 if names[0].isalpha() else 1)


def test_months_cover_the_windows():
    weeks = mondays(date(2026, 1, 5), 2)
    assert grid_months(weeks) == ["2025-11", "2025-12", "2026-01", "2026-02"]


def test_table_size(spark):
    df = spark.range(1000).selectExpr("id % 7 as a", "if(id % 2 = 0, null, id) as b")
    assert tuple(table_size(df, ["a", "b"]).first()) == (1000, 7, 500)
    near = table_size(df, ["a", "b"], approx=0.05).first()
    assert near["rows"] == 1000 and near["unique_a"] == 7 and abs(near["unique_b"] - 500) < 75
