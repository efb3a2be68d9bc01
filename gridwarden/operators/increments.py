"""Adding rows to a stored table that is unique by key, as if all rows had been there from the start.

The table keeps the order columns by which the first row of a key is picked. New rows are reduced
among themselves, then compared with those stored rows alone that have the same keys: only the
partitions and the key and order columns are read for that, and Spark tests the keys against a
filter of the new ones before the join. Partitions are written anew only where a stored row gives way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .dedup import keep_by_key

MONTH = "month"


def start_table(rows: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], ts: str = "ts_utc") -> None:
    """Write the table: one row per key, the first by ``order``, by month, sorted by key."""
    _write(keep_by_key(rows, list(keys), list(order)).withColumn(MONTH, F.date_format(ts, "yyyy-MM")), path, keys, "overwrite")


def _write(rows: DataFrame, path: str, keys: Sequence[str], mode: str) -> None:
    laid_out = rows.repartitionByRange(MONTH, *keys).sortWithinPartitions(MONTH, *keys)
    laid_out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; months are text, as they were written."""
    return spark.read.parquet(path).withColumn(MONTH, F.col(MONTH).cast("string"))


def add_rows(
    rows: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], ts: str = "ts_utc"
) -> dict[str, int]:
    """Add ``rows`` (the table's columns but for the month): ``added``, ``dropped`` as later copies,
    and ``replaced``, stored rows that turned out to be the later ones. ``ts`` is one of the keys, so
    copies lie in one month."""
    if ts not in keys:
        raise ValueError(f"{ts} must be one of the keys, or copies could lie in several months")
    spark, keys, order = rows.sparkSession, list(keys), list(order)
    kind = read_table(spark, path).schema
    new = keep_by_key(rows, keys, order).withColumn(MONTH, F.date_format(ts, "yyyy-MM"))
    new = cut_lineage(new.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in kind.fields]))
    months = [r[MONTH] for r in new.select(MONTH).distinct().collect()]  # a row a month
    stored = read_table(spark, path).where(F.col(MONTH).isin(*months)) if months else read_table(spark, path).limit(0)
    names = {c: f"_old_{c}" for c in order}
    held = stored.select(MONTH, *keys, *[F.col(c).alias(n) for c, n in names.items()])
    compared = new.join(held, [MONTH, *keys], "left")
    clashes = F.col(names[order[0]]).isNotNull()
    earlier = F.struct(*order) < F.struct(*names.values())
    marked = cut_lineage(
        compared.withColumn("_state", F.when(~clashes, "added").when(earlier, "replaced").otherwise("dropped")).drop(*names.values())
    )
    counts = {r["_state"]: r["count"] for r in marked.groupBy("_state").count().collect()}  # three rows
    winners = marked.where("_state <> 'dropped'").drop("_state")
    changed = [r[MONTH] for r in marked.where("_state = 'replaced'").select(MONTH).distinct().collect()]
    in_changed = F.col(MONTH).isin(*changed) if changed else F.lit(False)
    if changed:
        losers = marked.where("_state = 'replaced'").select(MONTH, *keys)
        stays = read_table(spark, path).where(in_changed).join(losers, [MONTH, *keys], "left_anti")
        # written apart first, as these partitions are read and then replaced
        _write(cut_lineage(stays.unionByName(winners.where(in_changed))), path, keys, "overwrite")
    _write(winners.where(~in_changed), path, keys, "append")
    return {state: counts.get(state, 0) for state in ("added", "replaced", "dropped")}
