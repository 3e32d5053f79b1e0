"""Checks of the price model."""

from __future__ import annotations

from pyspark.sql import functions as F

from civica import fixtures as fx
from civica.checks.registry import check
from civica.checks.tables import sql
from civica.fixed_values import MODEL_COLUMNS
from civica.plans import kpis, place_ridge, price_model
from civica.session import scratch_path
from civica.sources import models
from civica.sources.collections import read_collections, write_collection

KEY = "property_id"


def _rows(spark, sf, *columns):
    joined = kpis.listings_with_income(fx.listing(spark, sf), fx.income(spark, sf), [KEY])
    return joined.select(KEY, *columns)


def _split(spark, sf, columns=("neighborhood", "price")):
    rows = _rows(spark, sf, *columns)
    return price_model.stored_split(rows, KEY, scratch_path(spark, "model_rows"))


@check("train_split", sql("SELECT property_id, part FROM split_listing", "split_listing"))
def train_split(spark, sf):
    return price_model.with_split(_rows(spark, sf), KEY)


@check("label_index", sql("""
    SELECT neighborhood, CAST(idx AS DOUBLE) AS neighborhood_index FROM groups""", "groups"))
def label_index(spark, sf):
    places = _split(spark, sf)[0].select("neighborhood")
    return price_model.label_indexer().fit(places).transform(places.distinct())


@check("price_model", sql("""
    SELECT neighborhood, neighborhood_index, round(coefficient, 2) AS coefficient,
           round(intercept, 2) AS intercept FROM model""", "model"))
def price_model_query(spark, sf):
    train, _ = _split(spark, sf)
    rows = price_model.coefficients(price_model.fit_price_model(train), train)
    return rows.withColumns({
        name: F.round(name, 2) for name in ("coefficient", "intercept")})


@check("place_ridge", sql("""
    SELECT neighborhood, neighborhood_index, round(coefficient, 2) AS coefficient,
           round(intercept, 2) AS intercept FROM model""", "model"))
def place_ridge_query(spark, sf):
    """The same model in closed form."""
    train, _ = _split(spark, sf)
    return place_ridge.fit_place_ridge(train).withColumns({
        name: F.round(name, 2) for name in ("coefficient", "intercept")})


def _quality_sql(part: str) -> str:
    return f"""
        SELECT '{part}' AS part,
               round(1 - sum((price - prediction) ** 2) / (var_pop(price) * count(*)), 6) AS r2,
               round(avg(abs(price - prediction)), 2) AS mean_absolute_error
        FROM scored WHERE part = '{part}'"""


@check("model_metrics", sql(_quality_sql("train") + " UNION ALL " + _quality_sql("test"), "scored"))
def model_metrics(spark, sf):
    train, test = _split(spark, sf)
    model = price_model.fit_price_model(train)
    parts = [
        price_model.fit_quality(price_model.score(model, part)).select(
            F.lit(name).alias("part"),
            F.round("r2", 6).alias("r2"),
            F.round("mean_absolute_error", 2).alias("mean_absolute_error"))
        for name, part in (("train", train), ("test", test))
    ]
    return parts[0].unionByName(parts[1])


SCORED_SQL = sql("""
    SELECT property_id, round(prediction, 2) AS prediction, price
    FROM scored WHERE part = 'test'""", "scored")


@check("score_listings", SCORED_SQL)
def score_listings(spark, sf):
    train, test = _split(spark, sf)
    scored = price_model.score(price_model.fit_price_model(train), test, KEY)
    return scored.withColumn("prediction", F.round("prediction", 2))


@check("place_ridge_scores", SCORED_SQL)
def place_ridge_scores(spark, sf):
    train, test = _split(spark, sf)
    scored = place_ridge.score_place_ridge(place_ridge.fit_place_ridge(train), test, KEY)
    return scored.withColumn("prediction", F.round("prediction", 2))


@check("kpi_price_model", SCORED_SQL)
def kpi_price_model(spark, sf):
    """The whole job: join, split, fit, save, load and score."""
    train, test = _split(spark, sf, MODEL_COLUMNS)
    path = scratch_path(spark, "price_model")
    models.save_model(price_model.fit_price_model(train), path)
    scored = price_model.score(models.load_model(path), test, KEY)
    return scored.withColumn("prediction", F.round("prediction", 2))


@check("actual_range", sql("""
    SELECT min(price) AS lowest, max(price) AS highest FROM split_listing
    WHERE part = 'test'""", "split_listing"))
def actual_range(spark, sf):
    return price_model.price_range(price_model.split(_rows(spark, sf, "price"), KEY)[1])


@check("model_roundtrip", sql("""
    SELECT property_id, true AS same FROM scored WHERE part = 'test'""", "scored"))
def model_roundtrip(spark, sf):
    """Predictions of the fitted and of the reloaded model, side by side."""
    train, test = _split(spark, sf)
    fitted = price_model.fit_price_model(train)
    path = scratch_path(spark, "model_roundtrip")
    models.save_model(fitted, path)
    before = price_model.score(fitted, test, KEY, "neighborhood")
    before = before.select(KEY, "neighborhood", F.col("prediction").alias("before"))
    after = models.load_model(path).transform(before)
    return after.select(KEY, (F.col("before") == F.col("prediction")).alias("same"))


@check("model_as_rows")
def model_as_rows(spark, sf):
    train, _ = _split(spark, sf)
    path = scratch_path(spark, "model_as_rows")
    models.save_model(price_model.fit_price_model(train), path)
    rows = models.model_rows(spark, path)
    return rows.select("file", "length", F.sha2("content", 256).alias("digest"))


@check("model_restored", SCORED_SQL)
def model_restored(spark, sf):
    """Saved, stored as a collection of rows, read, written back to files, loaded and scored."""
    train, test = _split(spark, sf)
    path, store, again = (scratch_path(spark, name) for name in ("model", "model_store", "model_again"))
    models.save_model(price_model.fit_price_model(train), path)
    write_collection(models.model_rows(spark, path), "model", store, append=False)
    models.restore_model(read_collections(spark, ["model"], store)["model"], again)
    scored = price_model.score(models.load_model(again), test, KEY)
    return scored.withColumn("prediction", F.round("prediction", 2))
