"""Column profiles and the cleaning steps driven by them.

Every profile is one aggregate over all columns at once, so the number of jobs does
not depend on the number of columns, and only one-row results reach the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica.fixed_values import MAX_NULL_SHARE, MAX_TOP_SHARE, MIN_STDDEV
from civica.operators.filters import drop_incomplete
from civica.operators.ordering import stored

TOTAL = "__total"


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _null_counts(df: DataFrame) -> DataFrame:
    nulls = [F.count_if(_quoted(name).isNull()).alias(name) for name in df.columns]
    return df.agg(F.count(F.lit(1)).alias(TOTAL), *nulls)


def null_profile(df: DataFrame) -> DataFrame:
    """Rows ``(column, nulls, total)``, one per column."""
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            _quoted(name).alias("nulls"),
            F.col(TOTAL).alias("total"),
        )
        for name in df.columns
    ]
    return _null_counts(df).select(F.inline(F.array(*cells)))


def drop_sparse_columns(df: DataFrame, limit: float = MAX_NULL_SHARE) -> DataFrame:
    """Drop columns whose share of NULLs is above ``limit``."""
    row = _null_counts(df).first()
    total = row[TOTAL]
    return df.drop(*[name for name in df.columns if total and row[name] / total > limit])


def _deviations(names: list[str]) -> list[Column]:
    return [F.stddev_samp(_quoted(name)).alias(f"sd_{name}") for name in names]


def _too_even(row: Row, names: list[str], floor: float) -> list[str]:
    found = {name: row[f"sd_{name}"] for name in names}
    return [name for name, sd in found.items() if sd is not None and sd < floor]


def drop_low_variance(df: DataFrame, floor: float = MIN_STDDEV) -> DataFrame:
    """Drop numeric columns whose sample deviation is below ``floor``."""
    names = numeric_columns(df)
    if not names:
        return df
    return df.drop(*_too_even(df.agg(*_deviations(names)).first(), names, floor))


def _tracked(limit: float) -> int:
    """How many values a sketch keeps per column, so that none of a share above ``limit``
    can be missed: its counts are off by less than a hundredth of that share."""
    if not 0.001 <= limit <= 1:
        raise ValueError("the share of a dominant value must be from 0.001 to 1")
    return max(1000, math.ceil(400 / limit))


def _top_hashes(names: list[str], limit: float) -> list[Column]:
    """Hashes of the values of each text column that may hold a share above ``limit``.

    At most 1 / limit values can. A frequent-items sketch of fixed size finds them; no value
    is shuffled, which matters for columns where nearly every value is different.
    """
    tracked = _tracked(limit)
    most = math.ceil(1 / limit) + 1
    return [
        F.expr(f"approx_top_k(xxhash64(`{name}`), {most}, {tracked})").alias(f"top_{name}")
        for name in names
    ]


def drop_dominant(df: DataFrame, limit: float = MAX_TOP_SHARE) -> DataFrame:
    """Drop text columns whose most frequent value (NULL is one) holds a share above
    ``limit``, by two aggregates: a sketch of each column, and exact counts of its candidates."""
    names = text_columns(df)
    if not names:
        return df
    row = df.agg(F.count(F.lit(1)).alias(TOTAL), *_top_hashes(names, limit)).first()
    return _drop_dominant(df, names, row, limit)


def _drop_dominant(df: DataFrame, names: list[str], row: Row, limit: float) -> DataFrame:
    total = row[TOTAL]
    # What the sketch puts clearly below the limit needs no count.
    least = (limit - 0.02 * limit) * total if total else 0
    candidates = [(name, item["item"]) for name in names for item in row[f"top_{name}"] or [] if item["count"] >= least]
    if not total or not candidates:
        return df
    counts = df.agg(*[
        F.count_if(F.xxhash64(_quoted(name)) == F.lit(item)).alias(f"n{k}")
        for k, (name, item) in enumerate(candidates)]).first()
    return df.drop(*{name for (name, _), n in zip(candidates, counts) if n / total > limit})


def clean_full(
    df: DataFrame,
    max_nulls: float = MAX_NULL_SHARE,
    min_stddev: float = MIN_STDDEV,
    max_top: float = MAX_TOP_SHARE,
    store: bool = False,
) -> DataFrame:
    """Drop sparse columns, incomplete rows, near-constant numbers and dominant texts.

    Three passes in all: NULL counts; then deviations and majority candidates of the
    complete rows together, as neither step changes the rows; then the candidates'
    counts. Each reads df anew, which suits a table; with ``store`` df is written to the
    scratch folder first, for one that takes joins or aggregates to compute.
    """
    df = stored(df, "uncleaned") if store else df
    complete = drop_incomplete(drop_sparse_columns(df, max_nulls))
    numbers, texts = numeric_columns(complete), text_columns(complete)
    row = complete.agg(
        F.count(F.lit(1)).alias(TOTAL), *_deviations(numbers), *_top_hashes(texts, max_top)
    ).first()
    varied = complete.drop(*_too_even(row, numbers, min_stddev))
    return _drop_dominant(varied, texts, row, max_top)
