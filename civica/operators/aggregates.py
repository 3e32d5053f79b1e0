"""Grouped and whole-table aggregates. All are algebraic, so they combine map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.functions.statistics import safe_corr
from civica.operators.ordering import numbered, quoted, unused

CHUNK_VALUES = 10_000


def average_by(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def sum_by(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def corr_by(df: DataFrame, keys: Sequence[str], x: str, y: str, out: str) -> DataFrame:
    return df.groupBy(*keys).agg(safe_corr(x, y).alias(out))


def corr_whole(df: DataFrame, x: str, y: str, out: str) -> DataFrame:
    return df.agg(safe_corr(x, y).alias(out))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Row count per value, NULL included, in ascending order of the value."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.asc(column))


def deduplicate(df: DataFrame) -> DataFrame:
    """Keep one of each group of equal rows; copies collapse before the shuffle."""
    return df.dropDuplicates()


def collect_by(
    df: DataFrame, keys: Sequence[str], value: str, out: str, sums: Sequence[str] = ()
) -> DataFrame:
    """Sorted list of the values of each group, with sums of the columns in ``sums``.

    For dimension values such as the shapes of a district, whose number per group
    does not grow with the facts; ``collect_chunks`` takes any number. Equal values are
    counted before the shuffle and repeated afterwards, so copies of a value cost one row each.
    """
    totals = [F.sum(name).alias(name) for name in sums]
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), *totals)
    run = F.struct(F.col(value).alias("v"), F.col("__n").alias("n"))
    runs = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), run)))
    repeated = F.flatten(
        F.transform(runs, lambda run: F.array_repeat(run["v"], run["n"].cast("int"))))
    return counted.groupBy(*keys).agg(*totals, repeated.alias(out))


def collect_chunks(
    df: DataFrame, keys: Sequence[str], value: str, out: str, size: int = CHUNK_VALUES, chunk: str = "chunk"
) -> DataFrame:
    """The sorted values of each group in lists of ``size``, numbered from 0; the last one of a
    group holds what is left.

    A value's place in its group decides its list, so one value that stands more often than
    a list can hold fills several, and neither a group nor the copies of a value meet in one
    task. NULL values are left out, and so is a group without others; a NULL key is a group.
    """
    if size < 1:
        raise ValueError("a list must hold at least one value")
    (place,) = unused(df, "place")
    known = df.select(*quoted([*keys, value])).where(quoted([value])[0].isNotNull())
    placed = numbered(known, [value], keys, place)
    part = F.floor(F.col(place) / size).alias(chunk)
    lists = placed.groupBy(*quoted(keys), part).agg(F.array_sort(F.collect_list(f"`{value}`")).alias(out))
    return lists.select(*quoted([*keys, chunk, out]))
