"""Duplicates. "First" and "last" always follow explicit order columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _is_fixed_width(kind: T.DataType) -> bool:
    return isinstance(kind, FIXED_WIDTH) and not isinstance(kind, T.DecimalType)


def _never_null(column: str, kind: T.DataType) -> Column:
    """A number in the order of a fixed-width column, with null before everything, as in a sort."""
    c = F.col(f"`{column}`")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.coalesce(c.cast("double"), F.lit(float("-inf")))
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    return F.coalesce(c.cast("bigint"), F.lit(-(1 << 63)))


def keep_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: str = "first"
) -> DataFrame:
    """One whole row per key: the first or the last by ``order`` (which must be unique per key).

    Null keys compare equal, and a null order value comes before all others. Both forms reduce copies before the shuffle, so a key with very many
    copies sends one row per map task: fixed-width rows with one order column use a hash aggregate
    (no sort); other rows use ``row_number() = 1``, which Spark cuts map-side with a group limit.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    schema = df.schema
    rest = [f for f in schema.fields if f.name not in keys]
    if len(order) == 1 and all(_is_fixed_width(f.dataType) for f in rest):
        pick = F.min_by if keep == "first" else F.max_by
        by = _never_null(order[0], schema[order[0]].dataType)
        picks = [pick(F.col(f"`{f.name}`"), by).alias(f.name) for f in rest]
        return df.groupBy(*keys).agg(*picks).select(*[F.col(f"`{n}`") for n in schema.names])
    ordering = [F.col(c).asc() if keep == "first" else F.col(c).desc() for c in order]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct; nulls compare equal."""
    return df.distinct()


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, surplus full-row duplicates, surplus rows per key."""
    rows = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    by_key = rows.groupBy(*keys).agg(
        F.sum("_copies").alias("_rows"), F.count("*").alias("_distinct")
    )
    return by_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_rows") - F.col("_distinct")), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_keys"),
    )
