"""Names the tables are known by."""

from __future__ import annotations

# Columns each input must have.
TELEMETRY_KEYS = ("gateway_id", "ts_utc")
TELEMETRY_REQUIRED = ("gateway_id", "ts_utc", "reboot_cnt", "disconnection_cnt", "offline_duration_sec")
METER_REQUIRED = ("week_start", "gateway_id", "meters_expected", "meters_read")
VISIT_REQUIRED = (
    "visit_id", "gateway_id", "requested_on", "visited_on", "reason_reported", "outcome", "technician_hours",
)
REVIEW_REQUIRED = ("gateway_id", "Kategorie", "reviewed_on")
RANKING_COLUMNS = ("week_start", "rank", "gateway_id", "score", "reason")

# Telemetry counters and durations that cannot be negative.
NON_NEGATIVE_COLUMNS = (
    "reboot_cnt", "reboot_duration_sec", "r_cnt_power_cycle", "r_cnt_reboot", "r_cnt_unknown",
    "r_dur_power_cycle", "r_dur_reboot", "r_dur_unknown", "disconnection_cnt", "offline_duration_sec",
)

# Feature columns of each family, in output order.
TELEMETRY_FEATURES = (
    "total_reboots", "total_disconnections", "total_offline_seconds", "avg_offline_seconds",
    "max_offline_seconds", "total_reboot_duration", "avg_reboot_duration",
)
METER_FEATURES = ("total_meters_expected", "total_meters_read", "avg_read_rate", "min_read_rate")
VISIT_FEATURES = (
    "total_visits", "problems_fixed", "no_problem_found", "total_technician_hours",
    "avg_technician_hours", "parts_replaced_count",
)
FEATURE_COLUMNS = TELEMETRY_FEATURES + METER_FEATURES + VISIT_FEATURES

# Accepted names of the meter columns, best first.
EXPECTED_ALIASES = ("meters_expected", "meter_expected", "n_meters_expected", "expected")
READ_ALIASES = ("meters_read", "meter_read", "n_meters_read", "read")
