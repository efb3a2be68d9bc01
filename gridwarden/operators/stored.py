"""Stored moments: what a week's baseline needs of the past, kept by bucket of days and key.

A bucket's rows (count, mean, centred squares, extremes, first time) merge with those of others, so
the next week reads them and its own recent days instead of the whole baseline again. A bucket is
replaced as a whole when rows arrive for it late.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .anomaly import METRICS, STORED_DAYS, moment_columns, prepared_rows
from .weeks import ANCHOR, WeekGrid

BUCKET = "stored_bucket"


def bucket_start(ts: Column, days: int = STORED_DAYS) -> Column:
    since = F.date_diff(F.to_date(ts), F.lit(ANCHOR))
    return F.date_add(F.lit(ANCHOR), (F.floor(since / days) * days).cast("int"))


def touched_buckets(rows: DataFrame, ts: str = "ts_utc", days: int = STORED_DAYS) -> list[date]:
    """The buckets that ``rows`` fall into: as many as the calendar has, however many rows."""
    found = rows.select(bucket_start(F.col(f"`{ts}`"), days).alias("b")).where("b is not null").distinct()
    return sorted(r["b"] for r in found.collect())


def write_moments(
    telemetry: DataFrame,
    path: str,
    metrics: Sequence[str] = METRICS,
    key: str = "gateway_id",
    ts: str = "ts_utc",
    order: Sequence[str] = (),
    days: int = STORED_DAYS,
    only: Sequence[date] | None = None,
) -> None:
    """Store the moments of ``telemetry`` by bucket. ``only`` names the buckets to work out anew, from
    all of their rows: other buckets are neither read nor changed, a named one without rows goes.
    With ``order`` copies of (key, time) count once, the first; metrics are kept in their order."""
    spark = telemetry.sparkSession
    kind = telemetry.schema[ts].dataType.simpleString()
    if only is not None:
        ranges = [WeekGrid(b, b + timedelta(days=days), days, (), ()).in_range(f"`{ts}`", kind) for b in only]
        telemetry = telemetry.where(" or ".join(f"({r})" for r in ranges) or "false")
    rows = prepared_rows(telemetry, metrics, key, ts, order)
    marked = rows.where("ts is not null").withColumn(BUCKET, bucket_start(F.col("ts"), days))
    columns = moment_columns(len(metrics))
    found = spark.sql(f"SELECT {BUCKET}, k, {columns} FROM {{rows}} GROUP BY {BUCKET}, k", rows=marked)
    laid_out = found.repartitionByRange(BUCKET, "k").sortWithinPartitions(BUCKET, "k")
    mode = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    mode.partitionBy(BUCKET).parquet(path)
    if only:
        held = {r[BUCKET] for r in spark.read.parquet(path).select(BUCKET).distinct().collect()}
        kept = {r[BUCKET] for r in marked.select(BUCKET).distinct().collect()} if held & set(only) else set()
        for bucket in held & set(only) - kept:
            _delete(spark, f"{path.rstrip('/')}/{BUCKET}={bucket.isoformat()}")


def _delete(spark: SparkSession, folder: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(folder)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def add_late_rows(
    telemetry: DataFrame, late: DataFrame, path: str, ts: str = "ts_utc", days: int = STORED_DAYS, **options
) -> list[date]:
    """Bring the store up to date after ``late`` rows have joined ``telemetry``; the buckets replaced."""
    buckets = touched_buckets(late, ts, days)
    if buckets:
        write_moments(telemetry, path, ts=ts, days=days, only=buckets, **options)
    return buckets


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    """The stored moments; a filter on ``stored_bucket`` opens only those buckets' files."""
    return spark.read.parquet(path)
