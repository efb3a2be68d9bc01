"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_folder

# A side is broadcast only when its measured rows times this guess of their width stay below it.
BROADCAST_BYTES = 32 << 20

# A word of the size and shingle contracts: everything between blanks of these code points.
BLANKS = r"[\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once an application, so that functions which
    run there can import it wherever it is installed on the driver."""
    context = spark.sparkContext
    if any(Path(p).name == "gridwarden.zip" for p in context.listFiles):
        return
    top = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="gridwarden-py-")  # on the driver alone; Spark serves the file
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.addPyFile(shutil.make_archive(f"{folder}/gridwarden", "zip", top, "gridwarden"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def words_of(text: Column, separator: str = BLANKS) -> Column:
    return F.array_remove(F.split(text, separator), "")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id's text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))) % divisor


class Scratch:
    """Parquet tables in the checkpoint folder that the session names, for large steps of a job that
    are read more than once: smaller than a checkpoint's rows, and dropped as soon as the steps that
    read them are written themselves."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark)}/{uuid.uuid4()}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(conf).delete(path, True)


def is_small(df: DataFrame, row_bytes: int = 64, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the counted rows fit a broadcast. ``df`` should be written or checkpointed."""
    return df.count() * row_bytes <= limit


def small_or_not(df: DataFrame, row_bytes: int = 64) -> DataFrame:
    """The frame with a broadcast hint if its measured size allows one, else as it is (the join
    then shuffles both sides)."""
    return F.broadcast(df) if is_small(df, row_bytes) else df


def without_ids(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key is not in ``ids`` (one column, written or checkpointed)."""
    gone = small_or_not(ids.toDF("_gone"), 32)
    return docs.join(gone, docs[key].eqNullSafe(gone["_gone"]), "left_anti")


def by_bytes(texts: Sequence[str], most: int) -> Iterator[list[int]]:
    """Positions of consecutive texts in runs of about ``most`` characters; a longer text is alone."""
    run: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(i)
        size += len(text)
    if run:
        yield run


def slices(batches: Iterator, rows: int) -> Iterator:
    """Arrow batches cut into runs of at most ``rows`` rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
