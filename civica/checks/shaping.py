"""Checks of projections, schema shaping and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica import fixtures as fx
from civica.checks.registry import check
from civica.checks.tables import sql
from civica.fixed_values import (
    INCOME_FIELDS,
    LISTING_CONSTANT_COLUMNS,
    MODEL_COLUMNS,
    PARTY_COLOURS,
)
from civica.functions import names, numbers
from civica.operators import shaping


@check("project", sql("SELECT neighborhood, price, bathrooms, size FROM listing", "listing"))
def project(spark, sf):
    wanted = [name for name in MODEL_COLUMNS if name != "RFD"]
    return shaping.project(fx.listing(spark, sf), wanted)


@check("drop_cols", sql("""
    SELECT lower(district) AS district, lower(neighborhood) AS neighborhood, property_id,
           price, bathrooms, size
    FROM listing""", "listing"))
def drop_cols(spark, sf):
    unwanted = [*LISTING_CONSTANT_COLUMNS, "priceByArea", "parkingSpace", "detailedType", "absent"]
    return shaping.union_frames(
        [shaping.drop_columns(frame, unwanted) for frame in fx.raw_listings(spark, sf)])


@check("ratio", """
    SELECT o_orderkey, round(o_totalprice / nullif(o_orderkey % 7, 0), 4) AS quotient
    FROM orders""")
def ratio(spark, sf):
    quotient = numbers.ratio(F.col("o_totalprice"), F.col("o_orderkey") % 7)
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", F.round(quotient, 4).alias("quotient"))


@check("recast", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS price
    FROM orders""")
def recast(spark, sf):
    key = F.col("o_orderkey")
    text = F.when(key % 11 == 0, "unknown").otherwise(F.col("o_totalprice").cast("string"))
    rows = fx.table(spark, sf, "orders").select("o_orderkey", text.alias("price"))
    return shaping.recast_numbers(rows, ["price", "absent"])


@check("flatten_struct", sql("""
    SELECT property_id, price,
           CASE WHEN property_id % 2 = 1 THEN property_id % 3 = 1 END AS "hasParking",
           CASE WHEN property_id % 2 = 1 THEN property_id % 5 * 10 END AS "parkingPrice",
           CASE WHEN property_id % 2 = 0 THEN o_orderstatus END AS typology,
           CASE WHEN property_id % 2 = 0 THEN o_orderpriority END AS "subTypology"
    FROM listing""", "listing"))
def flatten_struct(spark, sf):
    flat = []
    for frame, column in zip(fx.raw_listings(spark, sf), ("parkingSpace", "detailedType")):
        lifted = shaping.flatten_struct(frame.select("property_id", "price", column), column)
        flat.append(shaping.flatten_struct(lifted, "suggestedTexts"))
    return shaping.union_frames(flat)


@check("array_first", sql("""
    SELECT "neigh_name " AS name, "RFD", pop, year FROM raw_income""", "raw_income"))
def array_first(spark, sf):
    rows = fx.raw_income(spark, sf).select(F.col("neigh_name ").alias("name"), "info")
    return shaping.first_record(rows, "info", INCOME_FIELDS)


def _flat_listings(spark, sf):
    """Raw listings without their constant columns, structs lifted."""
    flat = []
    for frame in fx.raw_listings(spark, sf):
        frame = shaping.drop_columns(frame, LISTING_CONSTANT_COLUMNS)
        for column in ("parkingSpace", "detailedType"):
            frame = shaping.flatten_struct(frame, column)
        flat.append(frame)
    return flat


FLAT_LISTING = """
    SELECT property_id, lower(district) AS district, lower(neighborhood) AS neighborhood, price,
           bathrooms, size, "priceByArea",
           CASE WHEN property_id % 2 = 1 THEN property_id % 3 = 1 END AS "hasParking",
           CASE WHEN property_id % 2 = 1 THEN property_id % 5 * 10 END AS "parkingPrice",
           CASE WHEN property_id % 2 = 0 THEN o_orderstatus END AS typology,
           CASE WHEN property_id % 2 = 0 THEN o_orderpriority END AS "subTypology"
    FROM listing"""


@check("align_union", sql(FLAT_LISTING, "listing"))
def align_union(spark, sf):
    return shaping.align_union(_flat_listings(spark, sf))


@check("align_types", """
    SELECT CAST(event_id AS INTEGER) AS event_id,
           CASE WHEN event_id % 9 <> 0 THEN value END AS value,
           CAST(user_id AS INTEGER) AS "user", event_type FROM events""")
def align_types(spark, sf):
    value = F.when(F.col("event_id") % 9 == 0, "none").otherwise(F.col("value").cast("string"))
    rows = fx.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        value.alias("value"),
        F.struct(F.col("user_id").alias("user")).alias("who"),
        "event_type",
    )
    target = T.StructType([
        T.StructField("event_id", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("who", T.StructType([T.StructField("user", T.IntegerType())])),
        T.StructField("not_here", T.StringType()),
    ])
    return shaping.flatten_struct(shaping.align_types(rows, target), "who")


@check("union_all", sql("""
    SELECT lower(district) AS "Nom_Districte", substr(district, 1, 2) AS "Codi_Districte",
           lower(neighborhood) AS "Nom_Barri", "Party",
           CAST(CAST("Votes" AS BIGINT) AS VARCHAR) AS "Votes" FROM elections""", "elections"))
def union_all(spark, sf):
    return shaping.union_frames(fx.raw_elections(spark, sf))


# The patterns of the name normaliser, over whole texts with accents and punctuation.
@check("normalize_name", r"""
    SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[^\w\s]', ' ', 'g'),
                                  '[^a-zA-Z0-9\s]', '', 'g') AS name FROM documents""")
def normalize_name(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", names.normalize_name(F.col("text")).alias("name"))


@check("normalize_name_tight", r"""
    SELECT doc_id, regexp_replace(lower(text), '[^\w\s]', '', 'g') AS name FROM documents""")
def normalize_name_tight(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", names.normalize_name(F.col("text"), tight=True).alias("name"))


@check("parse_decimal_comma", """
    SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN round(p_retailprice, 2) END AS price
    FROM part""")
def parse_decimal_comma(spark, sf):
    """Every seventh price has a thousands dot, which cannot be read."""
    text = numbers.decimal_comma_text(F.col("p_retailprice"), 2)
    dotted = F.concat(F.substring(text, 1, 1), F.lit("."), F.substring(text, 2, 99))
    mixed = F.when(F.col("p_partkey") % 7 == 0, dotted).otherwise(text)
    return fx.table(spark, sf, "part").select(
        "p_partkey", numbers.parse_decimal_comma(mixed).alias("price"))


@check("corr_class", """
    SELECT o_orderkey, CAST(least(floor((x + 1) / 2 * 7) + 1, 7) AS BIGINT) AS step
    FROM (SELECT o_orderkey, (o_orderkey % 201 - 100) / 100 AS x FROM orders)""")
def corr_class(spark, sf):
    value = (F.col("o_orderkey") % 201 - 100) / 100
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", numbers.step_class(value).cast("bigint").alias("step"))


@check("party_colour", sql("""
    SELECT neighborhood, "Party", CASE "Party" WHEN 'PP' THEN '#4e79a7'
           WHEN 'CAT-JUNTS+' THEN '#76b7b2' WHEN 'PSC' THEN '#e15759' END AS colour
    FROM elections""", "elections"))
def party_colour(spark, sf):
    colour = numbers.map_values(F.col("Party"), PARTY_COLOURS)
    return fx.elections(spark, sf).select("neighborhood", "Party", colour.alias("colour"))
