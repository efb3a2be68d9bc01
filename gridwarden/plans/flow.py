"""The whole flow: raw files in, cleaned tables, features, training table, comparison, ranking out.

The cleaned telemetry is written once and read back by the two stages that use it. The written
table cuts the lineage, is unique per (gateway, time) and is laid out by gateway and time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import date_format

from ..operators.cleaning import clean_reviews, clean_telemetry, clean_visits
from ..operators.compare import by_percent, compare_classes
from ..operators.features import gateway_features
from ..operators.labels import review_labels, training_table
from ..operators import profile, stored
from ..operators.anomaly import METRICS
from ..operators.ranking import FIRST_SCORED_WEEK, SCORED_WEEK_COUNT, TOP_N, rank_weeks, require_full
from ..operators.validate import validate
from ..operators.weeks import grid_months, mondays
from ..session import cut_lineage, use_utc
from ..sources import readers, sinks


def scored_weeks() -> list[date]:
    return mondays(FIRST_SCORED_WEEK, SCORED_WEEK_COUNT)


def run_flow(
    spark: SparkSession,
    data_dir: str,
    out_dir: str,
    weeks: Sequence[date] | None = None,
    n: int = TOP_N,
    meter_paths: Sequence[str] | None = None,
    visits_path: str | None = None,
    reviews_path: str | None = None,
) -> dict[str, DataFrame]:
    """Writes every output under ``out_dir`` and returns the tables read back from there."""
    use_utc(spark)
    base, out = data_dir.rstrip("/"), out_dir.rstrip("/")
    weeks = list(weeks or scored_weeks())

    raw = readers.read_telemetry(spark, f"{base}/telemetry", with_order=True)
    sinks.write_telemetry(clean_telemetry(raw, readers.FILE_ORDER), f"{out}/telemetry_clean")
    telemetry = spark.read.parquet(f"{out}/telemetry_clean").drop("month")

    raw_visits = readers.read_field_visits(
        spark, visits_path or [f"{base}/field_visits.csv", f"{base}/field_visits.parquet"]
    )
    visits = None
    if raw_visits is not None:
        sinks.write_parquet(clean_visits(raw_visits), f"{out}/field_visits_clean")
        visits = spark.read.parquet(f"{out}/field_visits_clean")

    reviews = readers.read_engineer_reviews(
        spark, reviews_path or f"{base}/engineer_reviews.csv", with_order=True
    )
    order = [c for c in readers.CSV_ORDER if c in reviews.columns]
    sinks.write_parquet(clean_reviews(reviews, order), f"{out}/engineer_reviews_clean")

    meter = readers.read_meter_reads(spark, meter_paths or readers.meter_read_paths(base))
    master = readers.read_gateway_master(spark, f"{base}/gateway_master.csv", with_order=True)
    features = gateway_features(master, telemetry, meter, visits, readers.CSV_ORDER)
    sinks.write_parquet(features, f"{out}/features")
    features = spark.read.parquet(f"{out}/features")

    training = training_table(features, review_labels(reviews, order), check=True)
    sinks.write_parquet(training, f"{out}/training_data")
    training = spark.read.parquet(f"{out}/training_data")
    sinks.write_csv(by_percent(compare_classes(training)), f"{out}/feature_comparison", single_file=True)

    # counters are non-negative after cleaning, so readings of 0 need not reach a shuffled join
    recent = readers.clean_months(spark, f"{out}/telemetry_clean", grid_months(weeks))
    ranking = rank_weeks(recent, weeks, n, floor=0.0, measure=True).orderBy("week_start", "rank")
    sinks.write_csv(ranking, f"{out}/ranking", single_file=True)
    ranking = readers.read_csv(spark, f"{out}/ranking")
    return {
        "telemetry_clean": telemetry,
        "features": features,
        "training_data": training,
        "feature_comparison": readers.read_csv(spark, f"{out}/feature_comparison"),
        "ranking": ranking,
        "checks": validate(ranking, weeks, n),
    }


def store_moments(spark: SparkSession, out_dir: str) -> None:
    """Moments of the cleaned telemetry of ``run_flow``, kept beside it for the weeks to come."""
    use_utc(spark)
    out = out_dir.rstrip("/")
    telemetry = spark.read.parquet(f"{out}/telemetry_clean").drop("month")
    stored.write_moments(telemetry, f"{out}/moments")


def add_telemetry(spark: SparkSession, new: DataFrame, out_dir: str, order: Sequence[str]) -> dict[str, int]:
    """Raw telemetry that arrived later goes into the cleaned table: cleaned, without copies of what is
    there (the stored reading counts), and into the moments of the buckets that it falls into."""
    use_utc(spark)
    out = out_dir.rstrip("/")
    path = f"{out}/telemetry_clean"
    held = spark.read.parquet(path).drop("month")
    clean = cut_lineage(clean_telemetry(new, order).select(*held.columns))
    months = [r[0] for r in clean.select(date_format("timestamp", "yyyy-MM")).distinct().collect()]  # a row a month
    known = readers.clean_months(spark, path, months).select("gateway_id", "ts_utc")
    added = cut_lineage(clean.join(known, ["gateway_id", "ts_utc"], "left_anti").select(*held.columns))
    sinks.write_telemetry(added, path, mode="append")
    telemetry = spark.read.parquet(path).drop("month")  # listed anew
    buckets = stored.add_late_rows(telemetry, added, f"{out}/moments")
    return {"given": clean.count(), "added": added.count(), "buckets": len(buckets)}


def rank_next(spark: SparkSession, out_dir: str, weeks: Sequence[date], n: int = TOP_N) -> DataFrame:
    """The ranking of some weeks from the stored moments; of the cleaned telemetry only the recent days
    of these weeks are read."""
    use_utc(spark)
    out = out_dir.rstrip("/")
    recent = readers.clean_months(spark, f"{out}/telemetry_clean", grid_months(weeks))
    moments = stored.read_moments(spark, f"{out}/moments")
    return rank_weeks(recent, weeks, n, floor=0.0, measure=True, moments=moments)


def rank_raw(
    spark: SparkSession,
    data_dir: str,
    out_path: str,
    weeks: Sequence[date] | None = None,
    n: int = TOP_N,
    full: bool = True,
) -> DataFrame:
    """The ranking straight from raw telemetry, neither cleaned nor made unique, with the first
    breach as the reason. With ``full`` a week with fewer than ``n`` gateways is an error."""
    use_utc(spark)
    weeks = list(weeks or scored_weeks())
    raw = readers.read_telemetry(
        spark,
        f"{data_dir.rstrip('/')}/telemetry",
        columns=["gateway_id", "ts_utc", *METRICS],
        months=grid_months(weeks),
    )
    timed = raw.withColumn("ts_utc", raw["ts_utc"].cast("timestamp"))
    ranking = rank_weeks(timed, weeks, n, reason_mode="first_breach", measure=True)
    sinks.write_csv(ranking.orderBy("week_start", "rank"), out_path, single_file=True)
    written = readers.read_csv(spark, out_path)
    return require_full(written, weeks, n) if full else written


def validate_file(
    spark: SparkSession, path: str, weeks: Sequence[date] | None = None, n: int = TOP_N
) -> DataFrame:
    """The checks of a ranking written as CSV."""
    return validate(readers.read_csv(spark, path), list(weeks or scored_weeks()), n)


def quality_report(
    spark: SparkSession,
    data_dir: str,
    meter_paths: Sequence[str] | None = None,
    visits_path: str | None = None,
    reviews_paths: Sequence[str] | None = None,
) -> DataFrame:
    """The profiles of telemetry (per file, by the columns of each, and overall) and of the other
    inputs that exist. Without telemetry files it says so and goes on."""
    use_utc(spark)
    base = data_dir.rstrip("/")
    try:
        files = readers.read_telemetry_groups(spark, f"{base}/telemetry", with_path=True)
        report = profile.profile_telemetry_files(files, readers.union_groups(files))
    except FileNotFoundError:
        report = spark.createDataFrame([("telemetry", "all", "rows", "0")], profile.RESULT)
    meters = readers.meter_read_paths(base)
    optional = [
        (profile.profile_meter, meter_paths or [meters[1], meters[0], *meters[2:]]),
        (profile.profile_visits, [visits_path] if visits_path else [f"{base}/field_visits.parquet", f"{base}/field_visits.csv"]),
        (
            profile.profile_reviews,
            reviews_paths or [f"{base}/engineer_reviews.csv", f"{base}/engineer_reviews.parquet"],
        ),
    ]
    for profiled, paths in optional:
        path = readers.first_existing(spark, paths)
        if path is not None:
            report = report.unionByName(profiled(readers.load_file(spark, path)))
    return report
