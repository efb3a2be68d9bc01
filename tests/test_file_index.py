"""Look-ups and distinct counts by file; rows added to a unique table."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gridwarden.operators import increments
from gridwarden.operators.dedup import keep_by_key
from gridwarden.sources import file_index, sinks

START = datetime(2024, 1, 1)


def readings(spark, gateways, hours, first=0):
    rows = [(f"{g:012X}", START + timedelta(hours=h), float(h)) for g in range(first, first + gateways) for h in range(0, hours, 4)]
    return spark.createDataFrame(rows, "gateway_id string, timestamp timestamp_ntz, x double")


def test_a_gateways_week_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    every = readings(spark, 100, 24 * 60)
    sinks.write_telemetry(every, path, partitions=24)
    file_index.write_index(spark, path)
    wanted, start, end = ["00000000000A", "000000000030"], START + timedelta(days=8), START + timedelta(days=15)
    files = file_index.files_for(spark, path, wanted, start, end)
    assert len(list((tmp_path / "t").rglob("part-*.parquet"))) > 24 and len(files) <= 4
    got = file_index.read_keys(spark, path, wanted, start, end).drop("month")
    want = every.where(F.col("gateway_id").isin(*wanted) & (F.col("timestamp") >= F.lit(start).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(end).cast("timestamp_ntz")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 84
    assert spark.read.parquet(path).count() == every.count()  # the index is no part of the table
    assert file_index.read_keys(spark, path, ["FFFFFFFFFFFF"]).count() == 0


def test_files_after_the_index_are_found(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_telemetry(readings(spark, 3, 48), path, partitions=2)
    assert file_index.read_keys(spark, path, ["000000000001"]).count() == 12  # no index yet
    file_index.write_index(spark, path, distinct=("gateway_id",))
    sinks.write_telemetry(readings(spark, 2, 48, first=50), path, partitions=1, mode="append")
    assert file_index.read_keys(spark, path, ["000000000032"]).count() == 12
    with pytest.raises(AnalysisException, match="not in its index"):
        file_index.distinct_counts(spark, path, ["gateway_id"])
    assert file_index.refresh_index(spark, path, distinct=("gateway_id",)) == 1
    assert file_index.refresh_index(spark, path, distinct=("gateway_id",)) == 0
    assert file_index.distinct_counts(spark, path, ["gateway_id"]).first().asDict() == {"rows": 60, "unique_gateway_id": 5}


def test_sketches_stay_within_their_error(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(60_000).select(
        F.lpad(F.hex(F.col("id") % 20_011), 12, "0").alias("gateway_id"),
        (F.lit(START).cast("timestamp") + F.expr("make_interval(0,0,0,0,0,0,id % 5003)")).alias("timestamp"),
    )
    rows.repartition(6).write.parquet(path)
    file_index.write_index(spark, path, distinct=("gateway_id", "timestamp"))
    found = file_index.distinct_counts(spark, path, ["gateway_id", "timestamp"]).first()
    assert found["rows"] == 60_000
    # three standard errors of 1.04 / sqrt(2^12)
    assert abs(found["unique_gateway_id"] / 20_011 - 1) < 0.049 and abs(found["unique_timestamp"] / 5003 - 1) < 0.049


def test_added_months_equal_a_full_run(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [
        (f"{g:03d}", START + timedelta(days=d), f"file{(d * 7 + g + c) % 5}", g * 100 + c, d * 10.0 + c)
        for g in range(8) for d in range(0, 70, 3) for c in range(1 + (g + d) % 3)
    ]
    df = spark.createDataFrame(rows, "gateway_id string, ts_utc timestamp_ntz, _file string, _row bigint, x double")
    keys, order = ["gateway_id", "ts_utc"], ["_file", "_row"]
    increments.start_table(df.where("_file = 'file2'"), path, keys, order)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*")}
    totals = {"added": 0, "replaced": 0, "dropped": 0}
    for file in ("file3", "file0", "file4", "file1"):
        for state, n in increments.add_rows(df.where(F.col("_file") == file), path, keys, order).items():
            totals[state] += n
        if file == "file3":  # later files replace nothing, so what is there stays untouched
            assert before.items() <= {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("part-*")}.items()
    got = sorted(map(tuple, increments.read_table(spark, path).drop("month").select(df.columns).collect()))
    assert got == sorted(map(tuple, keep_by_key(df, keys, order).collect())) and min(totals.values()) > 0
    assert increments.add_rows(df.limit(0), path, keys, order) == {"added": 0, "replaced": 0, "dropped": 0}
    with pytest.raises(ValueError, match="one of the keys"):
        increments.add_rows(df, path, ["gateway_id"], order)
