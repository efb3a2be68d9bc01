"""The registered queries: each operator over the whole sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_text, to_utc
from ..functions.ids import canonical_id, clean_id
from ..functions.numbers import non_negative, non_negative_or_null, number_or_zero
from ..functions.text import normalize_text
from ..operators import anomaly, cleaning, compare, dedup, features, increments, labels, profile, ranking, stored, validate
from ..session import checkpoint_folder, cut_lineage, use_utc
from ..sources import file_index, readers, sinks
from ..sources import sample_tables as sample

WEEKS = sample.SAMPLE_WEEKS
ROW_ORDER = ("event_id",)


def _rounded(df: DataFrame, names: Iterable[str], digits: int = 8) -> DataFrame:
    """Float noise differs between engines and runs, so results are compared rounded."""
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def _plain_time(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def weekly_rank_3sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.rank_weeks(sample.telemetry(spark, sf_dir), WEEKS, order=ROW_ORDER)


def weekly_rank_first_breach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry, neither cleaned nor made unique; the reason names the first breach."""
    return ranking.rank_weeks(sample.telemetry(spark, sf_dir), WEEKS, reason_mode="first_breach", measure=True)


def weekly_rank_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings sent twice with another value, and a week without any data."""
    weeks = (date(2023, 10, 2), *WEEKS)
    return ranking.rank_weeks(sample.repeated_telemetry(spark, sf_dir), weeks, order=("sent",))


def weekly_rank_sigma1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One deviation instead of three, so that many readings are flagged."""
    return ranking.rank_weeks(sample.telemetry(spark, sf_dir), WEEKS, sigma=1.0, order=ROW_ORDER)


def weekly_rank_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning, then the ranking with the floor that cleaning guarantees."""
    raw = sample.dirty_telemetry(spark, sf_dir).drop("source_file")
    clean = cleaning.clean_telemetry(raw, ("event_id", "copy"))
    return ranking.rank_weeks(clean, WEEKS, sigma=1.5, floor=0.0, derived=True)


def weekly_rank_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking from stored moments: some readings of two weeks arrive after the store was written."""
    path = _folder(spark, "moments")
    every = sample.telemetry(spark, sf_dir)
    late = (F.col("ts_utc") < F.lit("2024-01-12").cast("timestamp_ntz")) & (F.col("event_id") % 10 == 3)
    stored.write_moments(every.where(~late), path, order=ROW_ORDER)
    stored.add_late_rows(every, every.where(late), path, order=ROW_ORDER)
    return ranking.rank_weeks(every, WEEKS, order=ROW_ORDER, moments=stored.read_moments(spark, path))


def weekly_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all gateways for windows that are not whole weeks (21 and 3 days)."""
    return anomaly.score_weeks(
        sample.telemetry(spark, sf_dir),
        WEEKS,
        baseline_days=21,
        recent_days=3,
        sigma=1.5,
        order=ROW_ORDER,
        reason_mode="first_breach",
    )


def weekly_scores_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that begin on any day, some of them far apart: so many that they are joined as a table."""
    return anomaly.score_weeks(sample.telemetry(spark, sf_dir), sample.UNEVEN_WEEKS, sigma=1.5, order=ROW_ORDER)


def weekly_baseline_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = anomaly.baseline_stats(sample.telemetry(spark, sf_dir), WEEKS, order=ROW_ORDER)
    return _rounded(stats, [c for c in stats.columns if c.startswith(("mean_", "std_"))])


def hourly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly.flag_rows(sample.telemetry(spark, sf_dir), WEEKS, sigma=2.0, order=ROW_ORDER)


def clean_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleaning.clean_telemetry(sample.dirty_telemetry(spark, sf_dir), ("event_id", "copy"))
    return _plain_time(clean, "ts_utc", "timestamp")


def clean_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_visits(sample.visits(spark, sf_dir))


def clean_visits_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days read in the format of each column's first value only."""
    return cleaning.clean_visits(sample.foreign_visits(spark, sf_dir), infer_by=("l_orderkey", "line"))


def clean_reviews_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_reviews(sample.reviews(spark, sf_dir), ("copy",))


def labels_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.review_labels(sample.reviews(spark, sf_dir), ("copy",))


def gateway_id_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id form of the telemetry plus a spaced and an invalid variant, cleaned three ways."""
    raw = F.col("gateway_id")
    variants = F.array(raw, F.concat(F.substring(raw, 1, 5), F.lit(" "), F.substring(raw, 6, 20)), F.substring(raw, 1, 7))
    forms = sample.dirty_telemetry(spark, sf_dir).select(F.explode(variants).alias("raw")).distinct()
    return forms.select(
        "raw",
        clean_id(F.col("raw")).alias("cleaned"),
        clean_id(F.col("raw"), drop_spaces=True).alias("joined"),
        canonical_id(F.col("raw")).alias("canonical"),
    )


def value_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty numbers, times and texts through each conversion."""
    tele = sample.dirty_telemetry(spark, sf_dir)
    return tele.select(
        "event_id",
        "copy",
        non_negative(tele, "offline_duration_sec").alias("clipped"),
        number_or_zero(tele, "offline_duration_sec").alias("unclipped"),
        non_negative_or_null(tele, "offline_duration_sec").alias("clipped_or_null"),
        to_utc(tele, "ts_utc").cast("timestamp_ntz").alias("time"),
        day_text(tele, "ts_utc").alias("day"),
        normalize_text(F.col("gateway_id")).alias("text"),
    )


def duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = sample.dirty_telemetry(spark, sf_dir).drop("event_id", "copy")
    return dedup.duplicate_counts(dirty, ["gateway_id", "ts_utc"])


def table_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.table_size(sample.visits(spark, sf_dir), ["gateway_id", "visit_id", "visited_on"])


def telemetry_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.telemetry_features(sample.telemetry(spark, sf_dir))
    return _rounded(out, ["total_offline_seconds", "avg_offline_seconds", "max_offline_seconds", "avg_reboot_duration"])


def telemetry_features_absent_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = features.telemetry_features(sample.telemetry(spark, sf_dir).drop("reboot_duration_sec"))
    floats = ["total_offline_seconds", "avg_offline_seconds", "max_offline_seconds"]
    return _rounded(out, [*floats, "total_reboot_duration", "avg_reboot_duration"])


def meter_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.meter_features(sample.meter_reads(spark, sf_dir)), ["avg_read_rate", "min_read_rate"])


def visit_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = cleaning.clean_visits(sample.visits(spark, sf_dir))
    return _rounded(features.visit_features(cleaned), ["total_technician_hours", "avg_technician_hours"])


def _gateway_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.gateway_features(
        sample.gateway_master(spark, sf_dir),
        sample.telemetry(spark, sf_dir),
        sample.meter_reads(spark, sf_dir),
        cleaning.clean_visits(sample.visits(spark, sf_dir)),
        ("copy",),
    )


FLOAT_FEATURES = (
    "total_offline_seconds", "avg_offline_seconds", "max_offline_seconds", "avg_reboot_duration",
    "avg_read_rate", "min_read_rate", "total_technician_hours", "avg_technician_hours",
)


def gateway_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_gateway_features(spark, sf_dir), FLOAT_FEATURES)


def _training(spark: SparkSession, sf_dir: str, drop: bool) -> DataFrame:
    found = labels.review_labels(sample.reviews(spark, sf_dir), ("copy",))
    return labels.training_table(_gateway_features(spark, sf_dir), found, drop_empty_columns=drop)


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_training(spark, sf_dir, True), FLOAT_FEATURES)


def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(labels.value_counts(sample.reviews(spark, sf_dir), "Kategorie"), ["share"])


def class_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label classes of the documents by mean length."""
    docs = sample.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    marked = sample.table(spark, sf_dir, "labels").join(docs, "doc_id")
    graded = marked.select("n_chars", "toxic", (1 - F.col("quality")).alias("target"))
    return _rounded(compare.class_means(graded), ["n_chars", "toxic"])


def feature_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``place`` is the row's place in the sorted table, so that the order is part of the rows."""
    table = compare.by_percent(compare.compare_classes(_training(spark, sf_dir, False)))
    table = table.coalesce(1).withColumn("place", (F.monotonically_increasing_id() + 1).cast("int"))  # a row a feature
    return _rounded(table, ["Normal", "Schlecht", "difference", "difference_percent"], 6)


def dq_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_telemetry(sample.dirty_telemetry(spark, sf_dir).drop("event_id", "copy"), "source_file")


def dq_meter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_meter(sample.meter_reads(spark, sf_dir))


def dq_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_visits(sample.visits(spark, sf_dir))


def dq_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_reviews(sample.reviews(spark, sf_dir).drop("copy"))


def validate_ranking_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking is written once (checkpointed) and then checked, as a file would be."""
    return validate.validate(cut_lineage(weekly_rank_3sigma(spark, sf_dir)), WEEKS)


def validate_ranking_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same ranking with one defect per check put in."""
    first, second, last = (WEEKS[i].isoformat() for i in (0, 1, 3))
    good = weekly_rank_3sigma(spark, sf_dir)

    def at(week: str, rank: int):
        return (F.col("week_start") == week) & (F.col("rank") == rank)

    bad = good.select(
        F.when(at(last, 15), F.lit("2024-02-05")).otherwise(F.col("week_start")).alias("week_start"),
        F.when(at(second, 3), F.lit(2)).otherwise(F.col("rank")).alias("rank"),
        F.when(at(first, 1), F.lit("xyz")).otherwise(F.col("gateway_id")).alias("gateway_id"),
        F.when(~at(first, 4), F.col("score")).alias("score"),
        F.when(at(first, 5), F.lit(" "))
        .when(at(first, 6), F.repeat(F.lit("x"), 301))
        .when(~at(first, 7), F.col("reason"))
        .alias("reason"),
        F.lit(1).alias("note"),
    )
    return validate.validate(cut_lineage(bad), WEEKS)


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share, for what a query writes and reads back."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4()}"


def files_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remarks with quoted line breaks, written as CSV and read back by split."""
    path = _folder(spark, "notes")
    sinks.write_csv(sample.notes(spark, sf_dir), path)
    return readers.read_csv(spark, path, multiline=True)


def files_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The master as a single-byte CSV: its encoding is found out, and columns of numbers are typed."""
    path = _folder(spark, "master")
    marked = sample.gateway_master(spark, sf_dir).withColumn("name", F.concat("name", F.lit(" Größe")))
    marked.write.option("header", "true").option("escape", '"').option("encoding", "ISO-8859-1").csv(path)
    return _rounded(readers.read_gateway_master(spark, path), ["balance"])


def files_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry by month, the later files with another type and a column more, read back by name
    for three months."""
    path = _folder(spark, "telemetry")
    every = sample.telemetry(spark, sf_dir)
    early = every.where("ts_utc < timestamp'2024-01-20'").drop("reboot_duration_sec")
    late = every.where("ts_utc >= timestamp'2024-01-20'")
    late = late.withColumn("disconnection_cnt", F.col("disconnection_cnt").cast("double"))
    sinks.write_telemetry(early, path, ts="ts_utc")
    sinks.write_telemetry(late, path, ts="ts_utc", mode="append")
    found = readers.read_telemetry(spark, path, months=("2023-12", "2024-01", "2024-02"), with_order=True)
    return _plain_time(found.withColumn("has_place", F.col("_file").contains("month=") & (F.col("_row") >= 0)), "ts_utc").drop("_file", "_row")


def gateway_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some gateways' week from stored telemetry, through the index of its files."""
    path = _folder(spark, "indexed")
    sinks.write_telemetry(sample.telemetry(spark, sf_dir), path, ts="ts_utc", partitions=8)
    file_index.write_index(spark, path, ts="ts_utc")
    wanted = [f"{n:012X}" for n in (1, 2, 30, 31, 32)]
    found = file_index.read_keys(spark, path, wanted, datetime(2024, 1, 10), datetime(2024, 1, 17), ts="ts_utc")
    return _plain_time(found.drop("month"), "ts_utc")


def distinct_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct gateways and times merged from the sketches of the files: within 5 % of the truth."""
    path = _folder(spark, "sketched")
    every = sample.telemetry(spark, sf_dir)
    sinks.write_telemetry(every, path, ts="ts_utc")
    columns = ("gateway_id", "ts_utc")
    file_index.write_index(spark, path, ts="ts_utc", distinct=columns)
    found = file_index.distinct_counts(spark, path, columns)
    exact = {c: labels.distinct_values(every, c) for c in columns}
    near = [(F.abs(F.col(f"unique_{c}") / exact[c] - 1) < 0.05).alias(f"near_{c}") for c in columns]
    return found.select("rows", *near)


def increment_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings that arrive in three parts, copies among them earlier and later than what is stored."""
    path = _folder(spark, "unique")
    every = sample.repeated_telemetry(spark, sf_dir)
    part = F.pmod(F.col("sent") * 7, F.lit(3))
    keys = ("gateway_id", "ts_utc")
    increments.start_table(every.where(part == 1), path, keys, ("sent",))
    for n in (2, 0):
        increments.add_rows(every.where(part == n), path, keys, ("sent",))
    return _plain_time(increments.read_table(spark, path).drop("month", "sent", "reboot_duration_sec"), "ts_utc")


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    weekly_rank_3sigma,
    weekly_rank_first_breach,
    weekly_rank_repeated,
    weekly_rank_sigma1,
    weekly_rank_dirty,
    weekly_rank_stored,
    weekly_scores,
    weekly_scores_uneven,
    weekly_baseline_stats,
    hourly_flags,
    clean_telemetry,
    clean_visits,
    clean_visits_inferred,
    clean_reviews_first,
    labels_last,
    gateway_id_forms,
    value_forms,
    duplicate_counts,
    table_size,
    telemetry_features,
    telemetry_features_absent_metric,
    meter_features,
    visit_features,
    gateway_features,
    training_table,
    class_balance,
    class_means,
    feature_comparison,
    dq_telemetry,
    dq_meter,
    dq_visits,
    dq_reviews,
    validate_ranking_ok,
    validate_ranking_bad,
    files_csv,
    files_master,
    files_telemetry,
    gateway_lookup,
    distinct_by_sketch,
    increment_table,
)


def _in_utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: _in_utc(query) for query in QUERIES}
