"""Dirty numbers. A NaN means missing here, so it becomes null before any arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A decimal number or an infinity; keeps out Java-only spellings such as '5d'.
NUMBER_TEXT = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))$"


def nan_to_null(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(c, F.lit(None).cast("double"))
    return c


def to_number(df: DataFrame, name: str) -> Column:
    """The column as a number; unreadable values are null. Numeric columns keep their type."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return F.col(name).cast("int")
    if isinstance(kind, T.NumericType):
        return nan_to_null(df, name)
    if isinstance(kind, T.NullType):
        return F.lit(None).cast("double")
    text = F.trim(F.col(name).cast("string"), F.lit(" \t\n\r\f\x0b"))
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def number_or_zero(df: DataFrame, name: str) -> Column:
    return F.coalesce(to_number(df, name), F.lit(0))


def non_negative(df: DataFrame, name: str) -> Column:
    """Unreadable or missing is 0 and negatives are 0."""
    return F.greatest(number_or_zero(df, name), F.lit(0))


def non_negative_or_null(df: DataFrame, name: str) -> Column:
    """Negatives are 0, missing stays missing (``greatest`` would turn null into 0)."""
    x = to_number(df, name)
    return F.when(x < 0, F.lit(0)).otherwise(x)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """Ratio with 0 where the denominator is 0 or either side is missing; not clipped."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))
