"""Labels from engineer reviews, the training table and class balance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import drop_all_null_columns, require_columns
from ..functions.ids import clean_id
from ..functions.text import binary_target
from ..session import cut_lineage
from .dedup import keep_by_key


def review_labels(
    reviews: DataFrame, order: Sequence[str], positive: str = "schlecht", category: str = "Kategorie"
) -> DataFrame:
    """``gateway_key, target`` from the last review per gateway by ``order``."""
    require_columns(reviews, ["gateway_id", category], "Engineer review file")
    labelled = reviews.select(
        clean_id(F.col("gateway_id")).alias("gateway_key"),
        binary_target(F.col(category), positive).alias("target"),
        *order,
    ).where(F.col("gateway_key").isNotNull())
    return keep_by_key(labelled, ["gateway_key"], order, "last").select("gateway_key", "target")


def training_table(
    features: DataFrame, labels: DataFrame, drop_empty_columns: bool = True, check: bool = False
) -> DataFrame:
    """Features of the labelled gateways plus ``target``.

    Which columns are all null and (with ``check``, an error) whether anything matched depend on
    the data. For these the joined table, one row per labelled gateway, is checkpointed first, so
    that the features are computed once.
    """
    require_columns(features, ["gateway_id"], "Features table")
    keyed = features.withColumn("gateway_key", clean_id(F.col("gateway_id")))
    joined = keyed.join(labels, "gateway_key", "inner").drop("gateway_key")
    if check or drop_empty_columns:
        joined = cut_lineage(joined)
    if check and joined.isEmpty():
        raise ValueError("No matching gateways found between features and reviews")
    return drop_all_null_columns(joined) if drop_empty_columns else joined


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """``value, count, share``; nulls are left out unless asked for."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    counts = rows.groupBy(F.col(column).alias("value")).count()
    total = counts.agg(F.sum("count"))
    return counts.withColumn("share", F.col("count") / total.scalar())


def distinct_values(df: DataFrame, column: str) -> Column:
    """The number of distinct non-null values, as a scalar. Grouping instead of counting distinct
    keeps several of these apart; Spark would merge the latter into one pass over multiplied rows."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return values.agg(F.count("*")).scalar()


def table_size(df: DataFrame, distinct: Sequence[str] = (), approx: float | None = None) -> DataFrame:
    """One row: ``rows`` and the number of distinct non-null values of each listed column.

    Each column is counted on its own, so no row is multiplied. ``approx`` is the relative deviation
    allowed; the counts are then sketched in the one pass that counts the rows.
    """
    if approx is not None:
        sketches = [F.approx_count_distinct(name, approx).alias(f"unique_{name}") for name in distinct]
        return df.agg(F.count("*").alias("rows"), *sketches)
    exact = [distinct_values(df, name).alias(f"unique_{name}") for name in distinct]
    return df.agg(F.count("*").alias("rows")).select("rows", *exact)
