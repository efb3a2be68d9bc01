from gridwarden.operators import profile


def checks(df, scope="all"):
    return {r["check"]: r["value"] for r in df.collect() if r["scope"] == scope}


def test_telemetry(spark):
    data = [
        ("f1", "A", "2026-01-05 00:00:00", -1.0, 1, 2.0),
        ("f1", "A", "2026-01-05 00:00:00", -1.0, 1, 2.0),
        ("f1", "A", "2026-01-05 00:00:00", 3.0, None, float("nan")),
        ("f2", "A", "2026-01-05 00:00:00", -1.0, 1, 2.0),
        ("f2", "B", "bad", 0.0, -4, -2.0),
        ("f2", None, None, 0.0, 0, 0.0),
    ]
    df = spark.createDataFrame(data, "src string, gateway_id string, ts_utc string, reboot_cnt double, disconnection_cnt int, offline_duration_sec double")
    out = profile.profile_telemetry(df, "src")
    first = checks(out, "f1")
    assert first == {
        "rows": "3", "columns": "5", "missing_values": "2", "duplicate_rows": "1", "missing_required_columns": "",
        "negative_reboot_cnt": "2", "negative_disconnection_cnt": "0", "negative_offline_duration_sec": "0",
        "invalid_timestamps": "0", "first_timestamp": "2026-01-05 00:00:00.000000",
        "last_timestamp": "2026-01-05 00:00:00.000000",
    }
    assert checks(out, "f2")["invalid_timestamps"] == "2"
    assert checks(out) == {
        "rows": "6", "duplicate_rows": "2", "duplicate_gateway_timestamps": "3", "unique_gateways": "2",
    }
    partial = profile.profile_telemetry(df.drop("reboot_cnt"), "src")
    assert checks(partial, "f1")["missing_required_columns"] == "reboot_cnt"
    assert "invalid_timestamps" not in checks(partial, "f1")


def test_meter(spark):
    df = spark.createDataFrame([("w", "A", 0, 5), ("w", "A", 0, 5), ("w", "B", -1, -2), ("w", None, None, 1)], "week_start string, gateway_id string, meters_expected int, meters_read int")
    assert checks(profile.profile_meter(df)) == {
        "rows": "4", "columns": "4", "missing_values": "2", "duplicate_rows": "1", "missing_required_columns": "",
        "expected_zero": "2", "read_above_expected": "2", "negative_expected": "1", "negative_read": "1", "unique_gateways": "2",
    }
    assert checks(profile.profile_meter(df.limit(0)))["rows"] == "0"


def test_visits_and_reviews(spark):
    df = spark.createDataFrame(
        [("v1", "A", "2026-01-05", "2026-01-04", "r", "o", -1.0), ("v2", "A", "soon", None, "r", "o", 1.0)],
        "visit_id string, gateway_id string, requested_on string, visited_on string, reason_reported string, outcome string, technician_hours double",
    )
    found = checks(profile.profile_visits(df))
    assert {k: found[k] for k in ("negative_hours", "invalid_requested_dates", "invalid_visited_dates", "visited_before_requested", "unique_gateways", "unique_visits")} == {
        "negative_hours": "1", "invalid_requested_dates": "1", "invalid_visited_dates": "1",
        "visited_before_requested": "1", "unique_gateways": "1", "unique_visits": "2",
    }
    reviews = spark.createDataFrame([("A", "gut", "2026-02-01"), ("B", None, "x"), ("B", "gut", None)], "gateway_id string, Kategorie string, reviewed_on string")
    found = checks(profile.profile_reviews(reviews))
    assert (found["category:gut"], found["category:<null>"], found["invalid_review_dates"]) == ("2", "1", "2")
    assert "category:gut" not in checks(profile.profile_reviews(reviews.drop("reviewed_on")))
