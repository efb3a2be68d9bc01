import pytest
from pyspark.sql import functions as F

from gridwarden.operators import compare, features, labels


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_telemetry_features(spark):
    data = [("0a:01", "2", "1", "10"), ("0A 01", "x", "2", "-4"), ("0A01", None, None, "30"), (None, "1", "1", "1")]
    raw = spark.createDataFrame(data, "gateway_id string, reboot_cnt string, disconnection_cnt string, offline_duration_sec string")
    assert rows(features.telemetry_features(raw), "gateway_id") == [("0A01", 2.0, 3.0, 36.0, 12.0, 30.0, 0.0, 0.0)]
    with pytest.raises(ValueError):
        features.telemetry_features(raw.drop("gateway_id"))


def test_meter_features(spark):
    raw = spark.createDataFrame([("A", 0, 0), ("A", 0, 5), ("A", 10, 12), ("B", None, 1)], "gateway_id string, expected int, n_meters_read int")
    assert rows(features.meter_features(raw), "gateway_id") == [("A", 10, 17, pytest.approx(0.4), 0.0), ("B", 0, 1, 0.0, 0.0)]
    assert features.meter_features(raw.drop("expected")) is None
    assert features.meter_features(None) is None
    both = raw.withColumn("meters_expected", F.lit(24))
    assert rows(features.meter_features(both), "gateway_id")[1] == ("B", 24, 1, pytest.approx(1 / 24), pytest.approx(1 / 24))


def test_visit_features(spark):
    data = [
        ("v1", "A", " Fehler  behöben ", "2", "Netzteil"),
        ("v2", "A", "Kein Fehler gefunden", None, " N  A "),
        (None, "A", "Problem FIXED", "-1", None),
        ("v4", "A", None, "x", "None"),
        ("v5", "B", "no fault found", "1.5", "Kabel"),
    ]
    raw = spark.createDataFrame(data, "visit_id string, gateway_id string, outcome string, technician_hours string, parts_replaced string")
    assert rows(features.visit_features(raw), "gateway_id") == [
        ("A", 3, 2, 1, 1.0, 0.25, 1),
        ("B", 1, 0, 1, 1.5, 1.5, 1),
    ]
    assert features.visit_features(None) is None


MASTER = [("0a:01", "north", 5.0, 0), ("0A01", "south", 6.0, 1), ("0A02", None, None, 2)]


def test_gateway_features(spark):
    master = spark.createDataFrame(MASTER, "gateway_id string, region string, height double, o int")
    telemetry = spark.createDataFrame([("0A01", 2, 1, 10.0, 3.0)], "gateway_id string, reboot_cnt int, disconnection_cnt int, offline_duration_sec double, reboot_duration_sec double")
    meter = spark.createDataFrame([("0A02", 4, 2)], "gateway_id string, meters_expected int, meters_read int")
    out = features.gateway_features(master, telemetry, meter, None, ["o"])
    assert rows(out, "gateway_id") == [
        ("0A01", "north", 5.0, 2, 1, 10.0, 10.0, 10.0, 3.0, 3.0, 0, 0, 0.0, 0.0),
        ("0A02", None, None, 0, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 4, 2, 0.5, 0.5),
    ]
    assert "total_visits" not in out.columns
    with pytest.raises(ValueError, match="total_reboots"):
        features.gateway_features(master.withColumn("total_reboots", F.lit(1)), telemetry, order=["o"])
    with pytest.raises(ValueError, match="order"):
        features.gateway_features(master, telemetry)


def test_training_table(spark):
    table = spark.createDataFrame([("0a:01", 1, None), ("0A02", 2, None), ("0A03", 3, "x")], "gateway_id string, n int, note string")
    found = spark.createDataFrame([("0A01", 1), ("0A02", 0), ("0A09", 1)], "gateway_key string, target int")
    out = labels.training_table(table, found, check=True)
    assert out.columns == ["gateway_id", "n", "target"]
    assert rows(out, "n") == [("0a:01", 1, 1), ("0A02", 2, 0)]
    with pytest.raises(ValueError, match="No matching"):
        labels.training_table(table, found.where("gateway_key = '0A09'"), check=True)


def test_value_counts_and_size(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), (None, None)], "c string, d int")
    assert rows(labels.value_counts(df, "c"), "value") == [("a", 2, 2 / 3), ("b", 1, 1 / 3)]
    assert rows(labels.value_counts(df, "c", keep_null=True), "value") == [(None, 1, 0.25), ("a", 2, 0.5), ("b", 1, 0.25)]
    assert rows(labels.table_size(df, ["c", "d"]), "rows") == [(4, 2, 2)]


def test_comparison(spark):
    data = [(0, 1.0, 4, -2.0, 0), (0, 3.0, 4, -2.0, 0), (1, 6.0, float("nan"), -1.0, 3), (1, None, 1.0, -1.0, 3)]
    df = spark.createDataFrame([(t, a, float(b), c, d, "x") for t, a, b, c, d in data], "target int, a double, b double, c double, d int, s string")
    out = [tuple(r) for r in compare.by_percent(compare.compare_classes(df)).collect()]
    assert out == [
        ("a", 2.0, 6.0, 4.0, 200.0),
        ("c", -2.0, -1.0, 1.0, -50.0),
        ("b", 4.0, 1.0, -3.0, -75.0),
        ("d", 0.0, 3.0, 3.0, None),
    ]
    assert rows(compare.class_means(df), "target") == [(0, 2.0, 4.0, -2.0, 0.0), (1, 6.0, 1.0, -1.0, 3.0)]
    with pytest.raises(ValueError):
        compare.compare_classes(df.select("target", "s"))
