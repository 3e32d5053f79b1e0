"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(f"`{column}`") == F.lit(value))


def keep_not_in(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    """Rows whose value is none of ``values``; a NULL value is unknown and drops out."""
    return df.where(~F.col(f"`{column}`").isin(list(values)))


def keep_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(f"`{column}`").isNotNull())


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows that have a NULL in any column."""
    return df.dropna("any")
