"""Data-quality profiles as tidy tables: ``table, scope, check, value`` (value as text).

Every profile first counts the copies of each distinct row. That one aggregation is combined
map-side, answers the duplicate questions, and all other counts are sums over it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import is_missing, missing_columns
from ..functions.dates import to_day, to_utc
from ..functions.numbers import to_number
from .labels import distinct_values
from ..schema import METER_REQUIRED, REVIEW_REQUIRED, TELEMETRY_REQUIRED, VISIT_REQUIRED

TELEMETRY_COUNTERS = ("reboot_cnt", "disconnection_cnt", "offline_duration_sec")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
RESULT = "table string, scope string, check string, value string"


def _copies(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))


def _times(condition: Column) -> Column:
    """Rows (with copies) for which the condition is true."""
    return F.coalesce(F.sum(F.when(condition, F.col("_copies"))), F.lit(0))


def _basic(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    cells = sum((is_missing(df, n).cast("int") for n in columns), F.lit(0))
    return {
        "rows": F.coalesce(F.sum("_copies"), F.lit(0)),
        "columns": F.lit(len(columns)),
        "missing_values": F.coalesce(F.sum(cells * F.col("_copies")), F.lit(0)),
        "duplicate_rows": F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)),
    }


def _tidy(wide: DataFrame, table: str, scope: str | None = None) -> DataFrame:
    """One row per check; a wide row holds one scope."""
    checks = [c for c in wide.columns if c != scope]
    texts = wide.select(
        F.col(scope).cast("string").alias("scope") if scope else F.lit("all").alias("scope"),
        *[F.col(c).cast("string").alias(c) for c in checks],
    )
    return texts.unpivot("scope", checks, "check", "value").select(
        F.lit(table).alias("table"), "scope", "check", "value"
    )


def _required(df: DataFrame, required: Sequence[str]) -> Column:
    return F.lit(", ".join(missing_columns(df, required)))


def _telemetry_scopes(copies: DataFrame, columns: Sequence[str], scope: str, table: str) -> DataFrame:
    checks = {**_basic(copies, columns), "missing_required_columns": _required(copies, TELEMETRY_REQUIRED)}
    if not missing_columns(copies, TELEMETRY_REQUIRED):
        for name in TELEMETRY_COUNTERS:
            checks[f"negative_{name}"] = _times(to_number(copies, name) < 0)
        time = to_utc(copies, "ts_utc")
        checks["invalid_timestamps"] = _times(time.isNull())
        checks["first_timestamp"] = F.date_format(F.min(time), TIME_FORMAT)
        checks["last_timestamp"] = F.date_format(F.max(time), TIME_FORMAT)
    per_scope = copies.groupBy(scope).agg(*[c.alias(n) for n, c in checks.items()])
    return _tidy(per_scope, table, scope)


def _digest(columns: Sequence[str]) -> list[Column]:
    """Two independent 64-bit hashes of a row, which also tell apart where its nulls are."""
    nulls = F.concat(*[F.col(f"`{c}`").isNull().cast("string") for c in columns])
    values = [F.col(f"`{c}`") for c in columns]
    return [F.xxhash64(F.lit(seed), nulls, *values).alias(name) for seed, name in ((1, "_h1"), (2, "_h2"))]


def _telemetry_overall(copies: DataFrame, columns: Sequence[str], table: str) -> DataFrame:
    """Rows and duplicates over all files. Only the key and a digest of each row that a file has
    are shuffled again, and the rows of a key come together once for both questions."""
    keyed = copies.select("gateway_id", "ts_utc", *_digest(columns), "_copies").repartition("gateway_id", "ts_utc")
    by_row = keyed.groupBy("gateway_id", "ts_utc", "_h1", "_h2").agg(F.sum("_copies").alias("_copies"))
    by_key = by_row.groupBy("gateway_id", "ts_utc").agg(
        F.sum("_copies").alias("_copies"), F.count("*").alias("_distinct")
    )
    overall = by_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_copies") - F.col("_distinct")), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_gateway_timestamps"),
        F.count_distinct("gateway_id").alias("unique_gateways"),
    )
    return _tidy(overall, table)


def profile_telemetry(df: DataFrame, scope: str = "_path", table: str = "telemetry") -> DataFrame:
    """Per source file and overall. ``scope`` names the column that tells the file. All files count
    as having the frame's columns; see ``profile_telemetry_files`` for files that differ."""
    columns = [c for c in df.columns if c != scope]
    copies = _copies(df)
    out = _telemetry_scopes(copies, columns, scope, table)
    if not {"gateway_id", "ts_utc"} <= set(columns):
        return out
    return out.unionByName(_telemetry_overall(copies, columns, table))


def profile_telemetry_files(
    groups: Sequence[DataFrame], together: DataFrame, scope: str = "_path", table: str = "telemetry"
) -> DataFrame:
    """Per source file by the columns that the file has, and overall. ``groups`` holds a frame for
    each schema and ``together`` their union."""
    if len(groups) == 1:
        return profile_telemetry(groups[0], scope, table)
    parts = [_telemetry_scopes(_copies(df), [c for c in df.columns if c != scope], scope, table) for df in groups]
    columns = [c for c in together.columns if c != scope]
    if {"gateway_id", "ts_utc"} <= set(columns):
        parts.append(_telemetry_overall(_copies(together.select(*columns)), columns, table))
    return reduce(DataFrame.unionByName, parts)


def _profile(
    df: DataFrame,
    table: str,
    required: Sequence[str],
    conditions: dict[str, Column],
    unique: dict[str, str],
) -> DataFrame:
    checks = {**_basic(df, df.columns), "missing_required_columns": _required(df, required)}
    checks.update({name: _times(condition) for name, condition in conditions.items()})
    # Each distinct count reads its own column; beside the others it would multiply whole rows.
    checks.update({name: distinct_values(df, column) for column, name in unique.items()})
    return _tidy(_copies(df).agg(*[c.alias(n) for n, c in checks.items()]), table)


def profile_meter(df: DataFrame, table: str = "meter_reads") -> DataFrame:
    if missing_columns(df, METER_REQUIRED):
        return _profile(df, table, METER_REQUIRED, {}, {})
    expected, read = to_number(df, "meters_expected"), to_number(df, "meters_read")
    conditions = {
        "expected_zero": expected == 0,
        "read_above_expected": read > expected,
        "negative_expected": expected < 0,
        "negative_read": read < 0,
    }
    return _profile(df, table, METER_REQUIRED, conditions, {"gateway_id": "unique_gateways"})


def profile_visits(df: DataFrame, table: str = "field_visits") -> DataFrame:
    if missing_columns(df, VISIT_REQUIRED):
        return _profile(df, table, VISIT_REQUIRED, {}, {})
    requested, visited = to_utc(df, "requested_on"), to_utc(df, "visited_on")
    conditions = {
        "negative_hours": to_number(df, "technician_hours") < 0,
        "invalid_requested_dates": requested.isNull(),
        "invalid_visited_dates": visited.isNull(),
        "visited_before_requested": visited < requested,
    }
    unique = {"gateway_id": "unique_gateways", "visit_id": "unique_visits"}
    return _profile(df, table, VISIT_REQUIRED, conditions, unique)


def profile_reviews(df: DataFrame, table: str = "engineer_reviews") -> DataFrame:
    if missing_columns(df, REVIEW_REQUIRED):
        return _profile(df, table, REVIEW_REQUIRED, {}, {})
    conditions = {"invalid_review_dates": to_day(df, "reviewed_on").isNull()}
    out = _profile(df, table, REVIEW_REQUIRED, conditions, {"gateway_id": "unique_gateways"})
    categories = df.groupBy("Kategorie").agg(F.count("*").alias("n"))
    named = categories.select(
        F.lit(table).alias("table"),
        F.lit("all").alias("scope"),
        F.concat(F.lit("category:"), F.coalesce("Kategorie", F.lit("<null>"))).alias("check"),
        F.col("n").cast("string").alias("value"),
    )
    return out.unionByName(named)
