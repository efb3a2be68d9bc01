"""Table-level cleaning of telemetry, field visits and engineer reviews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import require_columns
from ..functions.dates import day_text, first_format, to_utc
from ..functions.ids import clean_id
from ..functions.numbers import non_negative, non_negative_or_null
from ..functions.text import blank_if_null
from ..schema import NON_NEGATIVE_COLUMNS, TELEMETRY_KEYS
from .dedup import distinct_rows, keep_by_key


def clean_telemetry(
    raw: DataFrame,
    order: Sequence[str],
    formats: Sequence[str] = (),
    counters: Sequence[str] = NON_NEGATIVE_COLUMNS,
    infer_format: bool = False,
) -> DataFrame:
    """Clean ids and times, drop rows without them, keep the first row per (gateway, time) by
    ``order``, and make counters non-negative numbers.

    With ``infer_format`` times are read in the format of their first value by ``order`` and in no
    other (one small job now); if that value has none, as without it.

    Counters are typed before the duplicates are dropped: the same result, with narrower rows in
    the shuffle.
    """
    require_columns(raw, TELEMETRY_KEYS, "Telemetry")
    present = [c for c in counters if c in raw.columns]
    only = first_format(raw, "ts_utc", order) if infer_format else None
    typed = raw.withColumns(
        {
            "gateway_id": clean_id(F.col("gateway_id")),
            "ts_utc": to_utc(raw, "ts_utc", formats, only),
            **{c: non_negative(raw, c) for c in present},
        }
    ).na.drop(subset=list(TELEMETRY_KEYS))
    unique = keep_by_key(typed, list(TELEMETRY_KEYS), order).drop(*order)
    return unique.withColumn("timestamp", F.col("ts_utc"))


def clean_visits(raw: DataFrame, formats: Sequence[str] = (), infer_by: Sequence[str] = ()) -> DataFrame:
    """Every column is optional; full-row duplicates go.

    With ``infer_by`` (order columns, which are then dropped) each date column is read in the format
    of its first value and in no other; a column whose first value has none is read as without it.
    """
    changes = {}
    if "gateway_id" in raw.columns:
        changes["gateway_id"] = clean_id(F.col("gateway_id"))
    for name in ("requested_on", "visited_on"):
        if name in raw.columns:
            changes[name] = day_text(raw, name, formats, first_format(raw, name, infer_by) if infer_by else None)
    if "technician_hours" in raw.columns:
        changes["technician_hours"] = non_negative_or_null(raw, "technician_hours")
    if "parts_replaced" in raw.columns:
        changes["parts_replaced"] = blank_if_null(F.col("parts_replaced"))
    return distinct_rows((raw.withColumns(changes) if changes else raw).drop(*infer_by))


def clean_reviews(raw: DataFrame, order: Sequence[str]) -> DataFrame:
    """Clean ids and keep the first review per gateway by ``order``."""
    require_columns(raw, ["gateway_id"], "Engineer review file")
    cleaned = raw.withColumn("gateway_id", clean_id(F.col("gateway_id")))
    return keep_by_key(cleaned, ["gateway_id"], order).drop(*order)
