"""Giving the raw datasets one set of district and neighbourhood names."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica import fixed_values as fv
from civica.functions.names import normalize_name
from civica.operators.joins import attach_lookup
from civica.operators.shaping import (
    align_union,
    drop_columns,
    first_record,
    flatten_struct,
    union_frames,
)


@dataclass(frozen=True)
class Lookup:
    """A lookup frame with the names of its raw and reconciled columns."""

    frame: DataFrame
    raw: str
    name: str

    @classmethod
    def from_files(cls, files: dict[str, DataFrame], entry: tuple[str, str, str]) -> "Lookup":
        file, raw, name = entry
        return cls(files[file], raw, name)


def _reconciled(df: DataFrame, raw: str, lookup: Lookup, out: str) -> DataFrame:
    return attach_lookup(df, lookup.frame, raw, lookup.raw, lookup.name, out)


def lookup_union(
    frames: Sequence[DataFrame], lookup: Lookup, raw: str, out: str
) -> DataFrame:
    """Union of frames with differing columns, joined with one lookup.

    The lookup is joined once, after the union, which equals joining each part.
    """
    return _reconciled(align_union(frames), raw, lookup, out)


def reconcile_income(
    frames: Sequence[DataFrame], districts: Lookup, neighborhoods: Lookup
) -> DataFrame:
    """Income rows ``district, neighborhood, RFD, pop, year`` (first record of each)."""
    rows = union_frames([drop_columns(frame, [fv.INCOME_ID]) for frame in frames])
    rows = first_record(rows, fv.INCOME_RECORDS, fv.INCOME_FIELDS)
    rows = _reconciled(rows, fv.INCOME_DISTRICT, districts, "district")
    rows = _reconciled(rows, fv.INCOME_NEIGHBORHOOD, neighborhoods, "neighborhood")
    return drop_columns(rows, [fv.INCOME_DISTRICT_CODE])


def reconcile_elections(
    frames: Sequence[DataFrame], districts: Lookup, neighborhoods: Lookup
) -> DataFrame:
    """Election rows with reconciled names; all other columns stay."""
    rows = drop_columns(union_frames(frames), [fv.ELECTION_DISTRICT_CODE])
    rows = _reconciled(rows, fv.ELECTION_DISTRICT, districts, "district")
    return _reconciled(rows, fv.ELECTION_NEIGHBORHOOD, neighborhoods, "neighborhood")


def reconcile_listings(
    frames: Sequence[DataFrame],
    districts: Lookup,
    neighborhoods: Lookup,
    normalize: bool = False,
) -> DataFrame:
    """Flattened listings over the union of all columns, with reconciled names.

    With ``normalize`` the raw names pass through the name normaliser first, for
    lookups that list normalised names.
    """
    flat = []
    for frame in frames:
        frame = drop_columns(frame, fv.LISTING_CONSTANT_COLUMNS)
        for column in fv.LISTING_STRUCTS:
            frame = flatten_struct(frame, column)
        flat.append(frame)
    rows = align_union(flat)
    if normalize:
        names = [name for name in fv.PLACE_KEYS if name in rows.columns]
        rows = rows.withColumns({name: normalize_name(F.col(name)) for name in names})
    rows = _reconciled(rows, "district", districts, "district")
    return _reconciled(rows, "neighborhood", neighborhoods, "neighborhood")
