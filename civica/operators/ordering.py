"""Places of rows in an order, for tables and groups of any size.

A window without a partition, or over one hot group, puts its rows into one task. Here rows
are sorted by range into many partitions, and the counts of the partitions before it
carry a group's numbering on. Rows that are equal in the whole order are spread by where
they stand in their file, so that not even copies of one row meet in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civica.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and return the table read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores in front as it takes to clash with no column."""
    taken, lead = {name.lower() for name in df.columns}, "__"
    while any(lead + name in taken for name in names):
        lead += "_"
    return [lead + name for name in names]


def numbered(
    df: DataFrame,
    order: Sequence[str],
    within: Sequence[str] = (),
    out: str = "position",
    descending: Sequence[str] = (),
    ties: bool = False,
) -> DataFrame:
    """Rows with their place in the order, from 0 and without gaps in each group.

    Equal rows get places next to each other; with ``ties`` all rows that are equal in
    ``order`` share the first of their places, and what follows leaves the gap that
    ``rank()`` leaves. NULL makes a group of its own; it comes first in an ascending order
    and last in a descending one. A column ``out`` of df is replaced.

    The rows are written twice to the scratch folder: as they come, which fixes what tells
    copies apart however often a task runs, and sorted.
    """
    part, at, file, row, first, before = unused(df, "part", "at", "file", "row", "first", "before")
    given = stored(df, "unordered").select(
        "*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    sorting = [c.desc() if name in descending else c.asc() for name, c in zip(order, quoted(order))]
    keys = [*quoted(within), *sorting, F.col(file), F.col(row)]
    ordered = given.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Within a sorted partition the running id of its rows is their place there.
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = stored(ordered.select(*quoted(df.columns), F.spark_partition_id().alias(part), inside.alias(at)), "ordered")

    counts = rows.groupBy(part, *quoted(within)).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(before))
    earlier = Window.partitionBy(*quoted(within)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    placed = _beside(rows, counts, [part, *within], [first, before])
    placed = placed.withColumn(at, F.col(at) - F.col(first) + F.col(before)).drop(first, before)
    if ties:
        # Equal rows of a partition meet first, so that what is compared across the
        # partitions is one row for each of them.
        firsts = placed.groupBy(part, *quoted(within), *quoted(order)).agg(F.min(at).alias(first))
        equal = Window.partitionBy(*quoted(within), *quoted(order))
        firsts = firsts.withColumn(first, F.min(first).over(equal))
        placed = _beside(placed, firsts, [part, *within, *order], [first]).withColumn(at, F.col(first))
    return placed.select(*quoted([c for c in df.columns if c != out]), F.col(at).alias(out))


def _beside(rows: DataFrame, other: DataFrame, keys: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """Rows with columns of a frame that holds one row for each combination of the keys."""
    names = unused(rows, *[f"key{i}" for i in range(len(keys))])
    named = other.select(*[c.alias(name) for c, name in zip(quoted(keys), names)], *wanted)
    same = F.lit(True)
    for c, name in zip(quoted(keys), names):
        same = same & c.eqNullSafe(F.col(name))
    return rows.join(named, same).drop(*names)
