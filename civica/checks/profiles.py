"""Checks of the profiling and cleaning steps."""

from __future__ import annotations

from civica import fixtures as fx
from civica.checks.registry import check
from civica.checks.tables import sql
from civica.operators import profiling

PROFILE_COLUMNS = ["event_id", "value", "event_type", "sparse", "const", "dominant", "holey"]


@check("null_profile", sql(
    " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", count(*) - count({name}) AS nulls, count(*) AS total"
        " FROM profile" for name in PROFILE_COLUMNS),
    "profile"))
def null_profile(spark, sf):
    return profiling.null_profile(fx.profile(spark, sf))


@check("drop_sparse_cols", sql("SELECT * EXCLUDE (sparse) FROM profile", "profile"))
def drop_sparse_cols(spark, sf):
    return profiling.drop_sparse_columns(fx.profile(spark, sf))


@check("drop_low_variance", sql("SELECT * EXCLUDE (const) FROM profile", "profile"))
def drop_low_variance(spark, sf):
    return profiling.drop_low_variance(fx.profile(spark, sf))


@check("drop_dominant", sql("SELECT * EXCLUDE (dominant) FROM profile", "profile"))
def drop_dominant(spark, sf):
    return profiling.drop_dominant(fx.profile(spark, sf))


@check("clean_full", sql("""
    SELECT event_id, value, event_type, holey FROM profile
    WHERE value IS NOT NULL AND event_type IS NOT NULL AND holey IS NOT NULL""", "profile"))
def clean_full(spark, sf):
    return profiling.clean_full(fx.profile(spark, sf))
