import pytest
from pyspark.sql import functions as F

from gridwarden.operators import cleaning, dedup, labels


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_keep_by_key_both_forms(spark):
    data = [("a", 1, 3, 1.5), ("a", 1, 2, 2.5), ("b", None, 9, None), ("b", None, 8, 7.0), (None, 1, 1, 4.0)]
    df = spark.createDataFrame(data, "k string, t int, o int, x double").repartition(3)
    wide = df.withColumn("note", F.concat(F.lit("n"), "o"))
    for keep, expected in (("first", [(None, 1, 1, 4.0), ("a", 1, 2, 2.5), ("b", None, 8, 7.0)]),
                           ("last", [(None, 1, 1, 4.0), ("a", 1, 3, 1.5), ("b", None, 9, None)])):
        assert rows(dedup.keep_by_key(df, ["k", "t"], ["o"], keep), "k") == expected
        sorted_form = dedup.keep_by_key(wide, ["k", "t"], ["o"], keep)
        assert rows(sorted_form.drop("note"), "k") == expected
        assert rows(sorted_form.select("note"), "note") == sorted((f"n{r[2]}",) for r in expected)
    with pytest.raises(ValueError):
        dedup.keep_by_key(df, ["k"], ["o"], "any")


def test_both_forms_reduce_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"), (F.col("id") * 1.0).alias("x"))
    narrow = dedup.keep_by_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in narrow and "Sort" not in narrow and "SortAggregate" not in narrow
    wide = dedup.keep_by_key(df.withColumn("s", F.col("id").cast("string") if "id" in df.columns else F.lit("x")), ["k"], ["o"])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_duplicate_counts(spark):
    df = spark.createDataFrame([("a", 1, "x")] * 3 + [("a", 1, "y"), ("b", None, None), ("b", None, None)], "g string, t int, v string")
    assert rows(dedup.duplicate_counts(df, ["g", "t"]), "rows") == [(6, 3, 4)]
    assert rows(dedup.duplicate_counts(df.limit(0), ["g", "t"]), "rows") == [(0, 0, 0)]


def test_clean_telemetry(spark):
    data = [
        (" 0a:00:00:00:00:01 ", "2026-01-05 00:00:00", "-3", "abc", 0, 0, "fw1"),
        ("0A0000000001", "2026-01-05 00:00:00", "9", "1", 0, 1, "fw2"),
        ("0A0000000001", "2026-01-05 01:00:00", "7", "5d", 1, 0, "fw3"),
        ("0A0000000001", "bad", "7", "1", 0, 2, "fw"),
        (None, "2026-01-05 00:00:00", "7", "1", 0, 3, "fw"),
        ("0A0000000002", "2026-01-05T02:00:00+02:00", None, " 5 ", 0, 4, None),
    ]
    raw = spark.createDataFrame(data, "gateway_id string, ts_utc string, offline_duration_sec string, reboot_cnt string, f int, r int, firmware string")
    out = cleaning.clean_telemetry(raw.repartition(4), ["f", "r"])
    assert out.columns == ["gateway_id", "ts_utc", "offline_duration_sec", "reboot_cnt", "firmware", "timestamp"]
    got = rows(out.select("gateway_id", F.col("timestamp").cast("string"), "offline_duration_sec", "reboot_cnt", "firmware"), "gateway_id", "timestamp")
    assert got == [
        ("0A0000000001", "2026-01-05 00:00:00", 0.0, 0.0, "fw1"),
        ("0A0000000001", "2026-01-05 01:00:00", 7.0, 0.0, "fw3"),
        ("0A0000000002", "2026-01-05 00:00:00", 0.0, 5.0, None),
    ]
    with pytest.raises(ValueError, match="ts_utc"):
        cleaning.clean_telemetry(raw.drop("ts_utc"), ["f"])


def test_clean_visits(spark):
    data = [
        ("v1", "0a:00:00:00:00:01", "2026-01-05", "2026-01-06 10:00", "-2", None),
        ("v1", "0A0000000001", "2026-01-05", "2026-01-06", "-1", ""),
        ("v2", "0A0000000001", "soon", "2026-01-06", None, "Netzteil"),
    ]
    raw = spark.createDataFrame(data, "visit_id string, gateway_id string, requested_on string, visited_on string, technician_hours string, parts_replaced string")
    assert rows(cleaning.clean_visits(raw), "visit_id") == [
        ("v1", "0A0000000001", "2026-01-05", "2026-01-06", 0.0, ""),
        ("v2", "0A0000000001", None, "2026-01-06", None, "Netzteil"),
    ]
    assert rows(cleaning.clean_visits(raw.select("visit_id")), "visit_id") == [("v1",), ("v2",)]


def test_reviews_first_but_labels_last(spark):
    data = [("0a0000000001", "gut", 0), ("0A0000000001", "Schlecht ", 1), ("0A0000000002", None, 0), (None, "gut", 0), (None, "schlecht", 1)]
    raw = spark.createDataFrame(data, "gateway_id string, Kategorie string, o int")
    assert rows(cleaning.clean_reviews(raw, ["o"]), "gateway_id") == [
        (None, "gut"), ("0A0000000001", "gut"), ("0A0000000002", None),
    ]
    assert rows(labels.review_labels(raw, ["o"]), "gateway_key") == [("0A0000000001", 1), ("0A0000000002", 0)]
    with pytest.raises(ValueError, match="Kategorie"):
        labels.review_labels(raw.drop("Kategorie"), ["o"])
