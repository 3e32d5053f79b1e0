"""The batch run: raw files to formatted collections to published results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica import fixed_values as fv
from civica.operators.aggregates import deduplicate
from civica.plans import kpis, price_model
from civica.plans.reconcile import (
    Lookup,
    reconcile_elections,
    reconcile_income,
    reconcile_listings,
)
from civica.sources.collections import read_collections, write_collection
from civica.sources.exports import export_all, export_csv, publish_csv
from civica.sources.files import load_files, load_snapshots
from civica.sources.models import model_rows, save_model

FORMATTED = ["listings", "income", "elections"]
LOOKUPS = [
    fv.INCOME_DISTRICT_LOOKUP,
    fv.INCOME_NEIGHBORHOOD_LOOKUP,
    fv.RENT_DISTRICT_LOOKUP,
    fv.RENT_NEIGHBORHOOD_LOOKUP,
]

LOOKUP_SCHEMAS = {file: f"{raw} string, {name} string" for file, raw, name in LOOKUPS}
INCOME_SCHEMA = (
    "district_name string, `neigh_name ` string, "
    "info array<struct<RFD: double, pop: int, year: int>>"
)

KPI_SCHEMAS = {
    "kpi1": "district string, avg_price double, participation double",
    "kpi2": "district string, correlation double",
    "kpi3": "district string, Party string, total_votes double, rank int",
    "avgprice_district": "district string, avg_price double",
    "avgprice_neighborhood": "neighborhood string, avg_price double",
}


@dataclass(frozen=True)
class RawZone:
    """Folders of the raw files. ``listings`` holds one folder per snapshot."""

    listings: str
    income: str
    elections: str
    lookups: str


def format_zone(
    spark: SparkSession, zone: RawZone, listing_schema: T.StructType | None = None
) -> dict[str, DataFrame]:
    """Load and reconcile the three datasets and remove equal rows."""
    tables = load_files(spark, zone.lookups, schemas=LOOKUP_SCHEMAS)
    income_names = [
        Lookup.from_files(tables, fv.INCOME_DISTRICT_LOOKUP),
        Lookup.from_files(tables, fv.INCOME_NEIGHBORHOOD_LOOKUP),
    ]
    rent_names = [
        Lookup.from_files(tables, fv.RENT_DISTRICT_LOOKUP),
        Lookup.from_files(tables, fv.RENT_NEIGHBORHOOD_LOOKUP),
    ]
    income = list(load_files(spark, zone.income, schemas={"json": INCOME_SCHEMA}).values())
    elections = list(load_files(spark, zone.elections).values())
    # The same listing in two snapshots is one row, so the snapshot is left out.
    listings = load_snapshots(spark, zone.listings, listing_schema).drop("snapshot")
    frames = {
        "listings": reconcile_listings([listings], *rent_names),
        "income": reconcile_income(income, *income_names),
        "elections": reconcile_elections(elections, *income_names),
    }
    return {name: deduplicate(frame) for name, frame in frames.items()}


def run_batch(
    spark: SparkSession,
    zone: RawZone,
    formatted: str,
    results: str,
    split_key: str = "property_id",
    listing_schema: T.StructType | None = None,
) -> None:
    """Run everything once: store the formatted data, then the KPIs and the model.

    Every table of results is written as CSV and published as a collection from there: the
    key figures as one file in order, the rows of the model in as many as there are tasks.
    Results are computed from the stored collections. These are plain files whose size
    Spark knows, and a lost executor costs no more than re-reading them.
    """
    for name, frame in format_zone(spark, zone, listing_schema).items():
        write_collection(frame, name, formatted, append=False)
    stored = read_collections(spark, FORMATTED, formatted)
    listings, income, elections = (stored[name] for name in FORMATTED)

    figures = {
        "kpi1": kpis.price_participation(listings, income, elections),
        "kpi2": kpis.price_income_correlation(listings, income),
        "kpi3": kpis.top_party_weighted(listings, elections),
        "avgprice_district": kpis.average_price(listings, income),
        "avgprice_neighborhood": kpis.average_price(listings, income, by="neighborhood"),
    }
    for name, frame in figures.items():
        path = f"{results}/csv/{name}"
        order = [F.desc("avg_price"), *frame.columns[:1]] if name.startswith("avgprice") else ["district"]
        export_csv(frame, path, order=order)
        publish_csv(spark, path, name, results, KPI_SCHEMAS[name])

    rows = kpis.listings_with_income(listings, income)
    rows = rows.select(split_key, *fv.MODEL_COLUMNS)
    export_all(rows, f"{results}/csv/model_data")
    publish_csv(spark, f"{results}/csv/model_data", "predictive_data", results, rows.schema)
    data = read_collections(spark, ["predictive_data"], results)["predictive_data"]
    train, _ = price_model.split(data, split_key)
    model = price_model.fit_price_model(train)
    folder = f"{results}/linear_regression"
    save_model(model, folder)
    stamped = model_rows(spark, folder).withColumn("model", F.lit("linear_regression"))
    write_collection(stamped, "predictive_model", results, append=False)
