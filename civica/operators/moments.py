"""Correlations put together from the moments of parts.

A part is any set of rows: the rows of one place, or the rows with one pattern of
NULLs. Its moments come from one cheap aggregate; a table of parts is small, and the
correlation of all rows follows from it exactly. Deviations are taken from the common
mean, so no digits are lost to large squares.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civica.functions.numbers import ratio


def value_moments(value: Column, prefix: str) -> list[Column]:
    """Count, mean, variance and range of one value, as aggregates."""
    return [
        F.count(value).alias(f"{prefix}_n"),
        F.avg(value).alias(f"{prefix}_mean"),
        F.var_pop(value).alias(f"{prefix}_var"),
        F.min(value).alias(f"{prefix}_low"),
        F.max(value).alias(f"{prefix}_high"),
    ]


def combine_correlation(parts: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """Correlation per ``keys`` from rows of part moments.

    Columns: ``n`` rows with both values, then ``x_mean, x_var, x_low, x_high``, the
    same for y, and ``cov``. A group in which either value is constant gives NULL.
    """
    group = Window.partitionBy(*keys)
    rows = F.sum("n").over(group)

    def off(name: str) -> Column:
        centre = ratio(F.sum(F.col("n") * F.col(f"{name}_mean")).over(group), rows)
        return F.col(f"{name}_mean") - centre

    def total(value: Column) -> Column:
        return F.sum(F.col("n") * value)

    def varied(name: str) -> Column:
        low, high = (F.when(F.col("n") > 0, F.col(f"{name}_{end}")) for end in ("low", "high"))
        return F.min(low) < F.max(high)

    x, y = F.col("x_off"), F.col("y_off")
    spread = F.sqrt(total(F.col("x_var") + x * x)) * F.sqrt(total(F.col("y_var") + y * y))
    value = F.when(varied("x") & varied("y"), ratio(total(F.col("cov") + x * y), spread))
    centred = parts.withColumns({"x_off": off("x"), "y_off": off("y")})
    return centred.groupBy(*keys).agg(value.alias(out))


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise correlations ``(x, y, r)`` of the upper triangle, from one pass.

    Each pair uses the rows where both of its values are present. Rows are grouped by
    which values are missing; within such a part one variance per column serves all
    pairs. That keeps the aggregate of six columns below the hundred fields up to which
    Spark compiles it; a correlation per pair with its own variances runs ten times
    slower.
    """
    pairs = list(combinations(columns, 2))
    missing = [F.col(c).isNull().cast("int") * 2**i for i, c in enumerate(columns)]
    aggregates = [F.count(F.lit(1)).alias("n")]
    for column in columns:
        value = F.col(column)
        aggregates += [
            F.sum(value).alias(f"sum {column}"),
            F.var_pop(value).alias(f"var {column}"),
            F.min(value).alias(f"low {column}"),
            F.max(value).alias(f"high {column}"),
        ]
    aggregates += [F.covar_pop(x, y).alias(f"cov {x} {y}") for x, y in pairs]
    parts = df.groupBy(sum(missing, F.lit(0)).alias("missing")).agg(*aggregates)

    def side(name: str, column: str) -> list[Column]:
        return [
            ratio(F.col(f"`sum {column}`"), F.col("n")).alias(f"{name}_mean"),
            F.col(f"`var {column}`").alias(f"{name}_var"),
            F.col(f"`low {column}`").cast("double").alias(f"{name}_low"),
            F.col(f"`high {column}`").cast("double").alias(f"{name}_high"),
        ]

    def cell(x: str, y: str) -> Column:
        # Within a part a column is there in all rows or in none.
        both = F.col(f"`low {x}`").isNotNull() & F.col(f"`low {y}`").isNotNull()
        return F.struct(
            F.lit(x).alias("x"),
            F.lit(y).alias("y"),
            F.when(both, F.col("n")).otherwise(F.lit(0)).alias("n"),
            *side("x", x),
            *side("y", y),
            F.col(f"`cov {x} {y}`").alias("cov"),
        )

    cells = F.array(*[cell(x, y) for x, y in pairs])
    return combine_correlation(parts.select(F.inline(cells)), ["x", "y"], "r")
