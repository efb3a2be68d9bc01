"""Session helpers: every time computation in this package is in UTC."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

UTC_NAMES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00"}


def build_session(app_name: str = "gridwarden", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC and adaptive execution on; ``conf`` entries win over the defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone; a runtime setting, so it works on a session someone else made."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(df: DataFrame) -> None:
    """Refuse to turn text or calendar days into instants in a session that is not in UTC."""
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def _local_folder() -> str:
    """A folder for a local session that names none; it goes when the process ends."""
    folder = tempfile.mkdtemp(prefix="gridwarden-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def checkpoint_folder(spark: SparkSession) -> str:
    """The application's own folder below the one that ``spark.checkpoint.dir`` names.

    A cluster has to name one; queries that write there while they are built fail without it. Only
    a session whose executors are threads of the driver (``local`` or ``local[n]``) gets a folder
    of its own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a shared folder")
            folder = _local_folder()
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows, written once to the session's checkpoint folder, so that later jobs neither
    recompute them nor depend on executors staying alive."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
