"""Files in, files out: sources, sinks and the whole flow, with the invariants its outputs keep."""

from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridwarden.operators import cleaning
from gridwarden.operators.weeks import mondays
from gridwarden.plans.flow import (
    add_telemetry, quality_report, rank_next, rank_raw, run_flow, scored_weeks, store_moments, validate_file,
)
from gridwarden.schema import TELEMETRY_FEATURES
from gridwarden.sources import readers, sinks

WEEKS = mondays(date(2026, 2, 2), 2)


@pytest.fixture(scope="module")
def data_dir(tmp_path_factory):
    base = tmp_path_factory.mktemp("data")
    rows = []
    start = datetime(2026, 1, 5)
    for g in range(20):
        gateway = f"0a:00:00:00:00:{g:02x}" if g % 2 else f"0A00000000{g:02X}"
        for h in range(0, 24 * 35, 4):
            spike = (h * 7 + g) % 97 == 0
            rows.append((gateway, start + timedelta(hours=h), (h % 5) + 500.0 * spike, h % 3 - (h % 50 == 0) * 9, int(spike)))
    frame = pd.DataFrame(rows, columns=["gateway_id", "ts", "offline_duration_sec", "disconnection_cnt", "reboot_cnt"])
    frame["ts_utc"] = frame["ts"].dt.strftime("%Y-%m-%dT%H:%M:%SZ")
    for month, part in frame.groupby(frame["ts"].dt.strftime("%Y-%m")):
        folder = base / "telemetry" / f"month={month}"
        folder.mkdir(parents=True)
        part = part.drop(columns="ts")
        part.to_parquet(folder / "part-0.parquet", index=False)
        again = part.head(50).assign(offline_duration_sec=9999.0, firmware="new")
        again.to_parquet(folder / "part-1.parquet", index=False)
        part.head(3).to_parquet(folder / "notes.parquet", index=False)
    master = "gateway_id,site,price\r\n" + "".join(f"0A00000000{g:02X},Süd € {g},{g}\r\n" for g in range(20))
    (base / "gateway_master.csv").write_bytes((master + "0A0000000003,zweiter,99\r\n").encode("cp1252"))
    pd.DataFrame(
        [(f"v{i}", f"0A00000000{i % 20:02X}", "2026-01-05", "2026-01-07", "r", "Fehler behöben" if i % 3 else "Kein Fehler", i % 4, None if i % 2 else "Kabel") for i in range(60)],
        columns=["visit_id", "gateway_id", "requested_on", "visited_on", "reason_reported", "outcome", "technician_hours", "parts_replaced"],
    ).to_csv(base / "field_visits.csv", index=False, encoding="utf-8-sig")
    pd.DataFrame(
        [(f"0a00000000{g:02x}", "Schlecht" if g % 3 == 0 else "gut", "2026-02-01") for g in range(15)] + [("0A0000000001", "schlecht", "2026-02-02")],
        columns=["gateway_id", "Kategorie", "reviewed_on"],
    ).to_csv(base / "engineer_reviews.csv", index=False)
    meter = pd.DataFrame([("2026-01-05", f"0A00000000{g:02X}", 10, g) for g in range(20)], columns=["week_start", "gateway_id", "meters_expected", "meters_read"])
    meter.to_csv(base / "meter_read_success.csv", index=False)
    meter.to_parquet(base / "meter_reads.parquet", index=False)
    return str(base)


@pytest.fixture(scope="module")
def outputs(spark, data_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return out, run_flow(spark, data_dir, out, WEEKS)


def test_cleaned_telemetry(outputs):
    table = outputs[1]["telemetry_clean"]
    n = table.count()
    assert n == 20 * 24 * 35 // 4
    assert table.select("gateway_id", "ts_utc").distinct().count() == n
    assert table.where("gateway_id is null or ts_utc is null or length(gateway_id) <> 12").count() == 0
    low = table.agg(F.min("reboot_cnt"), F.min("disconnection_cnt"), F.min("offline_duration_sec")).first()
    assert min(low) >= 0
    # of two files with the same keys the one that sorts first wins
    assert table.where("offline_duration_sec = 9999").count() == 0


def test_features_and_training(outputs):
    table = outputs[1]["features"]
    assert table.count() == table.select("gateway_id").distinct().count() == 20
    assert table.where(" or ".join(f"{c} is null or {c} < 0" for c in TELEMETRY_FEATURES)).count() == 0
    assert table.where("gateway_id = '0A0000000003'").first()["site"] == "Süd € 3"
    row = table.where("gateway_id = '0A0000000003'").first()
    assert (row["price"], row["total_visits"], row["avg_read_rate"], row["parts_replaced_count"]) == (3, 3, 0.3, 0)
    training = outputs[1]["training_data"]
    assert training.count() == 15
    assert {r["target"] for r in training.select("target").distinct().collect()} == {0, 1}
    assert training.where("gateway_id = '0A0000000001'").first()["target"] == 1
    compared = outputs[1]["feature_comparison"]
    assert "price" in [r["feature"] for r in compared.collect()]


def test_ranking(outputs):
    ranking = outputs[1]["ranking"]
    assert ranking.count() == 30
    assert outputs[1]["checks"].where("not ok").count() == 0
    assert sorted(int(r["rank"]) for r in ranking.where(f"week_start = '{WEEKS[0]}'").collect()) == list(range(1, 16))
    assert any(r["score"] not in ("0.0",) for r in ranking.collect())
    assert all("." in r["score"] for r in ranking.collect())


def test_layout_of_the_cleaned_table(spark, outputs):
    """Partitioned by month and sorted by gateway and time within each file."""
    table = spark.read.parquet(f"{outputs[0]}/telemetry_clean")
    assert {str(r["month"])[:7] for r in table.select("month").distinct().collect()} == {"2026-01", "2026-02"}
    rows = table.select("_metadata.file_path", "_metadata.row_index", "gateway_id", "timestamp").toPandas()
    for _, part in rows.groupby("file_path"):
        ordered = part.sort_values("row_index")[["gateway_id", "timestamp"]].reset_index(drop=True)
        assert ordered.equals(ordered.sort_values(["gateway_id", "timestamp"]).reset_index(drop=True))


def test_telemetry_reader(spark, data_dir, tmp_path):
    path = f"{data_dir}/telemetry"
    df = readers.read_telemetry(spark, path)
    assert "firmware" in df.columns and "month" not in df.columns
    assert df.count() == 20 * 24 * 35 // 4 + 100
    pruned = readers.read_telemetry(spark, path, columns=["gateway_id", "ts_utc"], months=["2026-02"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<gateway_id:string,ts_utc:string>" in plan
    assert 0 < pruned.count() < df.count()
    with pytest.raises(FileNotFoundError):
        readers.read_telemetry(spark, str(tmp_path))
    with pytest.raises(ValueError, match="nope"):
        readers.read_telemetry(spark, path, columns=["nope"])


def test_feature_telemetry_prefers_the_cleaned_table(spark, data_dir, outputs):
    cleaned = readers.feature_telemetry(spark, f"{outputs[0]}/telemetry_clean", f"{data_dir}/telemetry")
    fallback = readers.feature_telemetry(spark, f"{outputs[0]}/absent", f"{data_dir}/telemetry")
    assert cleaned.count() == fallback.count()
    assert fallback.agg(F.max("offline_duration_sec")).first()[0] < 9999


@pytest.mark.parametrize(
    ("encoding", "content", "expected"),
    [
        ("UTF-8", "id,t\n1,Süd €\n".encode("utf-8-sig"), "Süd €"),
        ("windows-1252", "id,t\n1,Süd €\n".encode("cp1252"), "Süd €"),
        ("ISO-8859-1", b"id,t\n1,S\xfcd \x81\n", "Süd \x81"),
    ],
)
def test_encodings(spark, tmp_path, encoding, content, expected):
    path = tmp_path / "m.csv"
    path.write_bytes(content)
    assert readers.text_encoding(spark, str(path)) == encoding
    df = readers.read_csv(spark, str(path), encoding)
    assert df.columns == ["id", "t"]
    assert df.first()["t"] == expected


def test_csv_order_follows_the_file(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("k,n\n" + "".join(f"k{i % 7},{i}\n" for i in range(60_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = readers.read_csv(spark, str(path), with_order=True)
        assert df.rdd.getNumPartitions() > 1
        from gridwarden.operators.dedup import keep_by_key

        first = keep_by_key(df, ["k"], readers.CSV_ORDER)
        last = keep_by_key(df, ["k"], readers.CSV_ORDER, "last")
        assert sorted(int(r["n"]) for r in first.collect()) == list(range(7))
        assert sorted(int(r["n"]) for r in last.collect()) == list(range(59_993, 60_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_small_readers(spark, data_dir, tmp_path):
    assert readers.first_existing(spark, [f"{data_dir}/no.csv", f"{data_dir}/meter_reads.parquet"]).endswith("meter_reads.parquet")
    assert readers.read_meter_reads(spark, f"{data_dir}/no.csv") is None
    assert readers.read_field_visits(spark, f"{data_dir}/no.csv") is None
    with pytest.raises(FileNotFoundError):
        readers.read_engineer_reviews(spark, f"{data_dir}/no.csv")
    with pytest.raises(FileNotFoundError):
        readers.read_gateway_master(spark, f"{data_dir}/no.csv")
    with pytest.raises(ValueError, match="Unsupported"):
        readers.load_file(spark, f"{data_dir}/x.xlsx")
    bundle = readers.load_all(spark, data_dir)
    assert {k: v.count() > 0 for k, v in bundle.items()} == dict.fromkeys(
        ["gateway_master", "meter_reads", "field_visits", "engineer_reviews", "telemetry"], True
    )


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([('say "hi", you', 19.0), (None, 0.5)], "t string, x double")
    sinks.write_csv(df, str(tmp_path / "out"), single_file=True)
    back = readers.read_csv(spark, str(tmp_path / "out"))
    assert sorted((r["t"] or "", r["x"]) for r in back.collect()) == [("", "0.5"), ('say "hi", you', "19.0")]


def test_cleaning_is_idempotent(spark, outputs):
    table = outputs[1]["telemetry_clean"]
    again = cleaning.clean_telemetry(table.withColumn("o", F.lit(0)).drop("timestamp"), ["o"])
    assert again.exceptAll(table.select(*again.columns)).isEmpty()


def test_raw_ranking_and_its_file(spark, data_dir, tmp_path):
    path = str(tmp_path / "raw_ranking")
    ranking = rank_raw(spark, data_dir, path, WEEKS)
    assert ranking.count() == 30
    assert all("first breach on" in r["reason"] for r in ranking.collect())
    assert validate_file(spark, path, WEEKS).where("not ok").isEmpty()
    assert len(scored_weeks()) == 8 and scored_weeks()[-1] == date(2026, 3, 23)
    assert not validate_file(spark, path).where("not ok").isEmpty()
    with pytest.raises(ValueError, match="only 20 gateways"):
        rank_raw(spark, data_dir, path, WEEKS, n=21)


def test_quality_report(spark, data_dir):
    report = quality_report(spark, data_dir).collect()
    assert {r["table"] for r in report} == {"telemetry", "meter_reads", "field_visits", "engineer_reviews"}
    files = {r["scope"].rsplit("/", 2)[-2] + "/" + r["scope"].rsplit("/", 1)[-1] for r in report if r["scope"] != "all"}
    assert files == {f"month=2026-0{m}/part-{p}.parquet" for m in (1, 2) for p in (0, 1)}
    found = {(r["table"], r["scope"].rsplit("/", 1)[-1], r["check"]): r["value"] for r in report if "month=2026-02" not in r["scope"]}
    assert found["telemetry", "all", "duplicate_gateway_timestamps"] == "100"
    assert found["telemetry", "part-1.parquet", "rows"] == "50"
    assert int(found["telemetry", "part-0.parquet", "negative_disconnection_cnt"]) > 0
    assert found["engineer_reviews", "all", "category:gut"] == "10"


def test_weeks_that_follow(spark, data_dir, tmp_path):
    """Half of the readings first, moments stored, the rest added: the ranking of the whole flow."""
    whole = run_flow(spark, data_dir, str(tmp_path / "whole"), WEEKS)
    raw = readers.read_telemetry(spark, f"{data_dir}/telemetry", with_order=True).where("firmware is null").drop("firmware")
    late = (F.col("ts_utc") >= "2026-01-19") | F.col("ts_utc").contains("T08:")
    out = tmp_path / "out"
    sinks.write_telemetry(cleaning.clean_telemetry(raw.where(~late), readers.FILE_ORDER), f"{out}/telemetry_clean")
    store_moments(spark, str(out))
    counts = add_telemetry(spark, raw, str(out), readers.FILE_ORDER)  # what is there already is given again
    assert counts["given"] == 20 * 24 * 35 // 4 and counts["given"] > counts["added"] > 0 and counts["buckets"] == 5
    assert add_telemetry(spark, raw, str(out), readers.FILE_ORDER)["added"] == 0
    got = rank_next(spark, str(out), WEEKS)
    columns = ["week_start", "rank", "gateway_id", "score", "reason"]
    text = lambda df: sorted(tuple(map(str, r)) for r in df.select(columns).collect())
    assert text(got) == text(whole["ranking"])
