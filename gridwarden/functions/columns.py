"""Schema-time helpers; only the two that must look at data start a job, and they say so."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import NUMBER_TEXT, to_number
from .text import NULL_TOKENS


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require_columns(df: DataFrame, required: Iterable[str], what: str) -> None:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} is missing required columns: {missing}")


def first_alias(df: DataFrame, aliases: Sequence[str]) -> str | None:
    """The first of the accepted names that the table has."""
    return next((name for name in aliases if name in df.columns), None)


def add_missing_as_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    absent = {name: F.lit(0.0) for name in names if name not in df.columns}
    return df.withColumns(absent) if absent else df


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating column."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def fill_numeric(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The listed columns that exist become numbers with 0 for missing; others are left alone."""
    present = [name for name in names if name in df.columns]
    return df.withColumns({n: F.coalesce(to_number(df, n), F.lit(0)) for n in present}) if present else df


def null_tokens(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Spellings of "missing" in text columns become null (a CSV reader takes only one token)."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.when(~F.col(n).isin(*tokens), F.col(n)) for n in text}) if text else df


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Runs one aggregation: which columns survive depends on the data."""
    counts = df.agg(*[F.count(F.when(~is_missing(df, n), 1)).alias(n) for n in df.columns]).first()
    return df.select(*[n for n in df.columns if counts[n] > 0])


def infer_numeric(df: DataFrame, keep_text: Iterable[str] = ()) -> DataFrame:
    """Text columns whose every non-null value reads as a number become double (one aggregation)."""
    skip = set(keep_text)
    names = [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip
    ]
    if not names:
        return df
    readable = df.agg(*[F.bool_and(F.trim(F.col(n)).rlike(NUMBER_TEXT)).alias(n) for n in names]).first()
    typed = {n: to_number(df, n) for n in names if readable[n]}
    return df.withColumns(typed) if typed else df
