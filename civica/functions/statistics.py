"""Correlation expressions that stay defined on constant groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(x: str | Column, y: str | Column) -> Column:
    """Pearson correlation over rows where both values are present.

    Plain ``corr`` divides by zero on a constant or one-row group, which is an
    error under ANSI mode; here such a group gives NULL. The three sums come from
    mergeable aggregates, so a hot group is combined on the map side.
    """
    spread = F.sqrt(F.regr_sxx(y, x) * F.regr_syy(y, x))
    return F.try_divide(F.regr_sxy(y, x), spread)
