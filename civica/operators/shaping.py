"""Column shaping: select, drop, rename, recast, flatten, align."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica.functions.numbers import to_double


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{name}`") for name in columns])


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns by name; names that are absent are ignored."""
    return df.drop(*columns)


def recast_numbers(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Turn the named columns, where present, into doubles; bad text becomes NULL."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: to_double(F.col(f"`{name}`")) for name in present})


def flatten_struct(df: DataFrame, column: str) -> DataFrame:
    """Lift the fields of a struct column to the top level and drop the struct.

    A frame without the column passes through. A field replaces a top-level column
    of the same name.
    """
    if column not in df.columns:
        return df
    fields = df.schema[column].dataType.fieldNames()
    lifted = {name: F.col(f"`{column}`").getField(name) for name in fields}
    if column in lifted:
        return df.withColumns(lifted)
    return df.withColumns(lifted).drop(column)


def first_record(df: DataFrame, column: str, fields: Sequence[str]) -> DataFrame:
    """Fields of an array's first record as columns; an empty array gives NULLs."""
    record = F.get(F.col(f"`{column}`"), F.lit(0))
    return df.withColumns({name: record.getField(name) for name in fields}).drop(column)


def _same_name(df: DataFrame) -> Callable[[str], str]:
    """Maps names that Spark takes for one to the same text."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return str if exact else str.lower


def _drifted(frames: Sequence[DataFrame]) -> set[str]:
    """Columns to unite as text: the frames disagree on a type, and not all are numbers.
    Nested columns are left to Spark."""
    same, types = _same_name(frames[0]), {}
    for frame in frames:
        for field in frame.schema.fields:
            if not isinstance(field.dataType, T.NullType):
                types.setdefault(same(field.name), set()).add(field.dataType)
    nested = (T.ArrayType, T.MapType, T.StructType)
    return {
        name for name, found in types.items()
        if len(found) > 1
        and not all(isinstance(t, T.NumericType) for t in found)
        and not any(isinstance(t, nested) for t in found)
    }


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones NULL.

    Numbers of different types take the wider one. A column that is text or a date in
    one frame and something else in another becomes text, so no value is lost.
    """
    same, drifted = _same_name(frames[0]), _drifted(frames)

    def alike(frame: DataFrame) -> DataFrame:
        names = [name for name in frame.columns if same(name) in drifted]
        return frame.withColumns({n: F.col(f"`{n}`").cast("string") for n in names}) if names else frame

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(alike, frames))


def align_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union over the union of all columns, in sorted column order. Names that differ in
    case alone are one column, under its first spelling."""
    same, names = _same_name(frames[0]), {}
    for frame in frames:
        for name in frame.columns:
            names.setdefault(same(name), name)
    return union_frames(frames).select(*[F.col(f"`{name}`").alias(name) for name in sorted(names.values())])


def align_types(df: DataFrame, target: T.StructType) -> DataFrame:
    """Give the columns shared with ``target`` its types; values that do not fit are NULL."""
    wanted = {field.name: field.dataType for field in target.fields}
    changed = {
        field.name: F.col(f"`{field.name}`").try_cast(wanted[field.name])
        for field in df.schema.fields
        if field.name in wanted and field.dataType != wanted[field.name]
    }
    return df.withColumns(changed) if changed else df
