"""Feature means of the two label classes side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_columns
from ..functions.numbers import nan_to_null


def class_means(df: DataFrame, features: Sequence[str] | None = None, target: str = "target") -> DataFrame:
    """One row per class with the mean of every numeric feature."""
    names = list(features) if features is not None else numeric_columns(df, [target])
    return df.groupBy(target).agg(*[F.avg(nan_to_null(df, n)).alias(n) for n in names])


def compare_classes(
    df: DataFrame, features: Sequence[str] | None = None, target: str = "target"
) -> DataFrame:
    """``feature, Normal, Schlecht, difference, difference_percent`` for targets 0 and 1.

    One aggregation computes all means; its single row is then turned into one row per feature.
    """
    names = list(features) if features is not None else numeric_columns(df, [target])
    if not names:
        raise ValueError("no numeric features to compare")
    means = []
    for i, name in enumerate(names):
        value = nan_to_null(df, name).cast("double")
        for label in (0, 1):
            means.append(F.avg(F.when(F.col(target) == label, value)).alias(f"m{i}_{label}"))
    literals = ["'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'" for name in names]
    rows = ", ".join(f"{lit}, m{i}_0, m{i}_1" for i, lit in enumerate(literals))
    table = df.agg(*means).selectExpr(f"stack({len(names)}, {rows}) as (feature, Normal, Schlecht)")
    difference = F.col("Schlecht") - F.col("Normal")
    return table.select(
        "feature",
        "Normal",
        "Schlecht",
        difference.alias("difference"),
        (F.try_divide(difference, F.col("Normal")) * 100).alias("difference_percent"),
    )


def by_percent(comparison: DataFrame) -> DataFrame:
    return comparison.orderBy(F.col("difference_percent").desc_nulls_last(), "feature")
