"""An index of a Parquet table by file: the range of keys and times, and sketches of distinct values.

A look-up of a few keys lists the files that may hold them and opens no others; distinct counts of
the whole table are merged from the files' sketches. The index lies beside the files, in a folder
that readers of the table ignore. Files that came after it are always opened, and gone ones forgotten,
so an index that is out of date costs time but no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDER = "_file_index"
SKETCH_LG = 12  # registers of a sketch, as a power of two: a relative error of about 1.6 percent


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/{FOLDER}"


def _listed(spark: SparkSession, path: str) -> DataFrame:
    """``path`` of every Parquet file below the table's folder, with its time of change; none is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    found = files.load(path).select(_plain(F.col("path")).alias("path"), "modificationTime")
    return found.where(~F.contains("path", F.lit(f"/{FOLDER}/")))


def _plain(path: Column) -> Column:
    """One spelling for local paths, whichever reader they come from."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _entries(df: DataFrame, key: str, ts: str, distinct: Sequence[str]) -> DataFrame:
    file = _plain(F.col("_metadata.file_path")).alias("path")
    changed = F.col("_metadata.file_modification_time").alias("changed")
    sketches = [F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), SKETCH_LG).alias(f"distinct_{c}") for c in distinct]
    rows = df.select(file, changed, *{key: 0, ts: 0, **dict.fromkeys(distinct, 0)})
    return rows.groupBy("path").agg(
        F.max("changed").alias("changed"),
        F.count("*").alias("rows"),
        F.min(key).alias("first_key"),
        F.max(key).alias("last_key"),
        F.min(ts).alias("first_time"),
        F.max(ts).alias("last_time"),
        *sketches,
    )


def _generation(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest complete index; each is written to a folder of its own."""
    location = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(path)}/*/_SUCCESS")
    store = location.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted(str(f.getPath().getParent()) for f in store.globStatus(location) or ())
    return spark.read.parquet(found[-1]) if found else None


def _write(entries: DataFrame, path: str) -> None:
    name = f"{datetime.now().strftime('%Y%m%d%H%M%S%f')}-{uuid.uuid4().hex[:8]}"
    entries.write.parquet(f"{_folder(path)}/{name}")


def write_index(
    spark: SparkSession, path: str, key: str = "gateway_id", ts: str = "timestamp", distinct: Sequence[str] = ()
) -> None:
    """Index all files, in one pass over the columns named."""
    _write(_entries(spark.read.parquet(path), key, ts, distinct), path)


def refresh_index(
    spark: SparkSession, path: str, key: str = "gateway_id", ts: str = "timestamp", distinct: Sequence[str] = ()
) -> int:
    """Index the files that are new or changed; how many they were. Others aren't opened."""
    old = _generation(spark, path)
    if old is None:
        write_index(spark, path, key, ts, distinct)
        return _generation(spark, path).count()
    current, new = _split(spark, path, old)
    if new:
        found = _entries(spark.read.option("basePath", path).parquet(*new), key, ts, distinct)
        current = current.unionByName(found)
    _write(current, path)
    return len(new)


def _split(spark: SparkSession, path: str, index: DataFrame) -> tuple[DataFrame, list[str]]:
    """The entries of files that are as they were, and the files without one."""
    listed = _listed(spark, path)
    same = (F.col("changed") == F.col("modificationTime")) & (index["path"] == listed["path"])
    current = index.join(listed, same, "left_semi")
    new = listed.join(index, same, "left_anti")
    return current, [r["path"] for r in new.select(listed["path"]).collect()]


def files_for(
    spark: SparkSession, path: str, keys: Sequence[str], start: datetime | None = None, end: datetime | None = None
) -> list[str]:
    """The files that may hold a row of one of the keys from ``start`` to before ``end``: those whose
    ranges hold a key and touch the time, and those that the index doesn't know."""
    index = _generation(spark, path)
    if index is None:
        return [r["path"] for r in _listed(spark, path).collect()]
    current, new = _split(spark, path, index)
    wanted = F.exists(F.lit(list(keys)), lambda k: k.between(F.col("first_key"), F.col("last_key")))
    if start is not None:
        wanted = wanted & (F.col("last_time") >= F.lit(start).cast(index.schema["last_time"].dataType))
    if end is not None:
        wanted = wanted & (F.col("first_time") < F.lit(end).cast(index.schema["first_time"].dataType))
    return sorted([r["path"] for r in current.where(wanted).select("path").collect()] + new)


def read_keys(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    start: datetime | None = None,
    end: datetime | None = None,
    key: str = "gateway_id",
    ts: str = "timestamp",
) -> DataFrame:
    """The rows of a few keys in a span of time, from the files that may hold them."""
    every = spark.read.parquet(path)
    files = files_for(spark, path, keys, start, end)
    if not files:
        return every.limit(0)
    rows = spark.read.option("basePath", path).schema(every.schema).parquet(*files).where(F.col(key).isin(*keys))
    kind = every.schema[ts].dataType
    if start is not None:
        rows = rows.where(F.col(ts) >= F.lit(start).cast(kind))
    return rows if end is None else rows.where(F.col(ts) < F.lit(end).cast(kind))


def distinct_counts(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``rows`` and the estimated number of distinct non-null values of each column, from the
    stored sketches of all files. The index must cover them: refresh it first."""
    index = _generation(spark, path)
    if index is None:
        raise AnalysisException(f"{path} has no index")
    current, new = _split(spark, path, index)
    if new:
        raise AnalysisException(f"{len(new)} files of {path} are not in its index")
    estimates = [F.hll_sketch_estimate(F.hll_union_agg(f"distinct_{c}")).alias(f"unique_{c}") for c in columns]
    return current.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), *estimates)
