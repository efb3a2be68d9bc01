"""One feature row per gateway."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import add_missing_as_zero, fill_numeric, first_alias, require_columns
from ..functions.ids import clean_id
from ..functions.numbers import number_or_zero, ratio_or_zero
from ..functions.text import (
    FIXED_OUTCOMES,
    NOTHING_FOUND_OUTCOMES,
    is_one_of,
    normalize_text,
    part_replaced,
)
from ..schema import EXPECTED_ALIASES, FEATURE_COLUMNS, READ_ALIASES
from .dedup import keep_by_key

TELEMETRY_INPUTS = ("reboot_cnt", "disconnection_cnt", "offline_duration_sec", "reboot_duration_sec")


def _keyed(df: DataFrame, **values) -> DataFrame:
    """Cleaned gateway id plus the named columns; rows without an id belong to no gateway."""
    columns = [c.alias(name) for name, c in values.items()]
    return df.select(clean_id(F.col("gateway_id"), drop_spaces=True).alias("gateway_id"), *columns).where(
        F.col("gateway_id").isNotNull()
    )


def telemetry_features(telemetry: DataFrame) -> DataFrame:
    """Totals, means and the maximum over the whole history; an absent metric counts as 0."""
    require_columns(telemetry, ["gateway_id"], "Telemetry")
    df = add_missing_as_zero(telemetry, TELEMETRY_INPUTS)
    rows = _keyed(df, **{name: number_or_zero(df, name) for name in TELEMETRY_INPUTS})
    return rows.groupBy("gateway_id").agg(
        F.sum("reboot_cnt").alias("total_reboots"),
        F.sum("disconnection_cnt").alias("total_disconnections"),
        F.sum("offline_duration_sec").alias("total_offline_seconds"),
        F.avg("offline_duration_sec").alias("avg_offline_seconds"),
        F.max("offline_duration_sec").alias("max_offline_seconds"),
        F.sum("reboot_duration_sec").alias("total_reboot_duration"),
        F.avg("reboot_duration_sec").alias("avg_reboot_duration"),
    )


def meter_features(
    meter: DataFrame | None,
    expected_aliases: Sequence[str] = EXPECTED_ALIASES,
    read_aliases: Sequence[str] = READ_ALIASES,
) -> DataFrame | None:
    """Totals, and the mean and minimum of the per-row read rate. None without usable columns."""
    if meter is None:
        return None
    expected, read = first_alias(meter, expected_aliases), first_alias(meter, read_aliases)
    if expected is None or read is None:
        return None
    rows = _keyed(meter, expected=number_or_zero(meter, expected), read=number_or_zero(meter, read))
    rated = rows.withColumn("rate", ratio_or_zero(F.col("read"), F.col("expected")))
    return rated.groupBy("gateway_id").agg(
        F.sum("expected").alias("total_meters_expected"),
        F.sum("read").alias("total_meters_read"),
        F.avg("rate").alias("avg_read_rate"),
        F.min("rate").alias("min_read_rate"),
    )


def visit_features(
    visits: DataFrame | None,
    fixed_terms: Iterable[str] = FIXED_OUTCOMES,
    nothing_found_terms: Iterable[str] = NOTHING_FOUND_OUTCOMES,
) -> DataFrame | None:
    """Visit count, outcome and part counts, and technician hours with missing hours as 0."""
    if visits is None:
        return None
    outcome = normalize_text(F.col("outcome"))
    rows = _keyed(
        visits,
        visit_id=F.col("visit_id"),
        fixed=is_one_of(outcome, fixed_terms),
        nothing_found=is_one_of(outcome, nothing_found_terms),
        part=part_replaced(normalize_text(F.col("parts_replaced"))),
        hours=number_or_zero(visits, "technician_hours"),
    )
    return rows.groupBy("gateway_id").agg(
        F.count("visit_id").alias("total_visits"),
        F.sum("fixed").alias("problems_fixed"),
        F.sum("nothing_found").alias("no_problem_found"),
        F.sum("hours").alias("total_technician_hours"),
        F.avg("hours").alias("avg_technician_hours"),
        F.sum("part").alias("parts_replaced_count"),
    )


def _left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    clash = sorted((set(left.columns) & set(right.columns)) - {key})
    if clash:
        raise ValueError(f"columns on both sides of the join: {clash}")
    return left.join(right, key, "left")


def gateway_features(
    master: DataFrame,
    telemetry: DataFrame,
    meter: DataFrame | None = None,
    visits: DataFrame | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """The master, one row per gateway (first by ``order``), with the feature families that are
    available joined on; missing numbers are 0.

    The master is made unique before the joins. Every joined side has one row per gateway, so the
    result is that of removing duplicates afterwards, and no key can fan out.
    """
    if not order:
        raise ValueError("order must say which of a gateway's rows in the master comes first")
    cleaned = master.withColumn("gateway_id", clean_id(F.col("gateway_id"), drop_spaces=True))
    cleaned = keep_by_key(cleaned, ["gateway_id"], order).drop(*order)
    out = _left_join(cleaned, telemetry_features(telemetry), "gateway_id")
    for family in (meter_features(meter), visit_features(visits)):
        if family is not None:
            out = _left_join(out, family, "gateway_id")
    return fill_numeric(out, FEATURE_COLUMNS)
