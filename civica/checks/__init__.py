"""Every operator and job as a query over the test tables, with SQL to compare it with."""

from civica.checks import (  # noqa: F401
    files,
    kpi,
    learning,
    profiles,
    relational,
    shaping,
)
from civica.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
