"""Ranks, top rows per group and ordered results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civica.operators.ordering import numbered


def rank_within(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """Rank rows of each group by descending value; equal values share a rank.

    Meant for aggregated tables: aggregate per group and item first.
    """
    window = Window.partitionBy(*keys).orderBy(F.desc(value))
    return df.withColumn(out, F.rank().over(window))


def rank_spread(df: DataFrame, keys: Sequence[str], value: str, out: str = "rank") -> DataFrame:
    """The ranks of ``rank_within`` for groups that are too large for one task, or for the
    whole table where ``keys`` is empty: a sort by range over many tasks, with counts and ties
    carried between them. Costs two written copies of df."""
    placed = numbered(df, [value], keys, out, descending=[value], ties=True)
    return placed.withColumn(out, F.col(f"`{out}`") + 1)


def top_within(
    df: DataFrame, keys: Sequence[str], value: str, k: int = 1, out: str = "rank"
) -> DataFrame:
    """Rows ranked ``k`` or better in their group, ties kept.

    The rank filter lets Spark drop worse rows of each group before the shuffle.
    """
    return rank_within(df, keys, value, out).where(F.col(out) <= k)


def order_descending(df: DataFrame, value: str, tie_break: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc(value), *[F.asc(name) for name in tie_break])
