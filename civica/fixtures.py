"""The test tables seen as listings, income and elections (see FIXTURES.md).

Orders are listings, suppliers give incomes, customers are electors. A customer's or
supplier's nation is the neighbourhood and its region the district.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica.functions.numbers import decimal_comma_text
from civica.operators.joins import join_on_keys
from civica.plans import kpis
from civica.plans.reconcile import Lookup

SEGMENT_PARTY = {
    "HOUSEHOLD": "Electors",
    "AUTOMOBILE": "PP",
    "BUILDING": "PSC",
    "MACHINERY": "CAT-JUNTS+",
}


SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the files once and given from then on, which
    spares a job per read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in SCHEMAS:
        SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(SCHEMAS[path]).parquet(path)


def _with_place(df: DataFrame, spark: SparkSession, sf_dir: str, nation_key: str) -> DataFrame:
    """Add district and neighbourhood. Each side is a plain scan, so Spark knows its
    size when it chooses whether to broadcast it."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    placed = df.join(nation, df[nation_key] == nation["n_nationkey"])
    placed = placed.join(region, placed["n_regionkey"] == region["r_regionkey"])
    return placed.withColumnsRenamed({"r_name": "district", "n_name": "neighborhood"})


def _orders_with_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer's place; a customer may hold any share of them."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    joined = join_on_keys(orders, customer, ["o_custkey"], spread_by=["o_orderkey"])
    return _with_place(joined, spark, sf_dir, "c_nationkey")


def _listing_columns() -> list[Column]:
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    size = (F.lit(20) + key % 180).cast("double")
    return [
        F.col("district"),
        F.col("neighborhood"),
        key.alias("property_id"),
        price.alias("price"),
        (key % 4 + 1).cast("double").alias("bathrooms"),
        size.alias("size"),
        (price / size).alias("priceByArea"),
    ]


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_with_place(spark, sf_dir).select(*_listing_columns())


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _with_place(table(spark, sf_dir, "supplier"), spark, sf_dir, "s_nationkey")
    return placed.groupBy("district", "neighborhood").agg(
        F.round(F.avg("s_acctbal"), 4).alias("RFD"), F.count(F.lit(1)).alias("pop"))


def _party(segment: Column) -> Column:
    pairs = [F.lit(item) for entry in SEGMENT_PARTY.items() for item in entry]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), segment), segment)


def elections(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = _with_place(table(spark, sf_dir, "customer"), spark, sf_dir, "c_nationkey")
    party = _party(F.col("c_mktsegment")).alias("Party")
    votes = F.count(F.lit(1)).cast("double").alias("Votes")
    return placed.groupBy("district", "neighborhood", party).agg(votes)


def raw_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation, with one income record per year (at most four).

    A nation without suppliers has an empty array.
    """
    supplier = table(spark, sf_dir, "supplier")
    year = (F.lit(2011) + F.col("s_suppkey") % 4).cast("int").alias("year")
    yearly = supplier.groupBy("s_nationkey", year).agg(
        F.max("s_acctbal").alias("RFD"),
        F.count(F.lit(1)).cast("int").alias("pop"))
    by_year = F.array_sort(F.collect_list(F.struct("year", "RFD", "pop")))
    records = F.transform(by_year, lambda r: F.struct(r["RFD"], r["pop"], r["year"]))
    records = records.cast("array<struct<RFD:double,pop:int,year:int>>")
    nations = yearly.groupBy("s_nationkey").agg(records.alias("info"))
    base = table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "key")
    region = table(spark, sf_dir, "region")
    base = base.join(region, base["n_regionkey"] == region["r_regionkey"])
    joined = base.join(nations, base["key"] == nations["s_nationkey"], "left")
    empty = F.array().cast("array<struct<RFD:double,pop:int,year:int>>")
    return joined.select(
        F.col("key").alias("_id"),
        F.lower("r_name").alias("district_name"),
        F.col("n_regionkey").alias("district_id"),
        F.lower("n_name").alias("neigh_name "),
        F.coalesce("info", empty).alias("info"),
    )


def raw_elections(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two frames with their columns in different order."""
    rows = elections(spark, sf_dir)
    raw = rows.select(
        F.lower("district").alias("Nom_Districte"),
        F.substring("district", 1, 2).alias("Codi_Districte"),
        F.lower("neighborhood").alias("Nom_Barri"),
        "Party",
        F.col("Votes").cast("bigint").cast("string").alias("Votes"),
    )
    electors = F.col("Party") == "Electors"
    return [
        raw.where(electors),
        raw.where(~electors).select(*reversed(raw.columns)),
    ]


def raw_listings(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Odd and even listings; each part has a struct column that the other lacks."""
    placed = _orders_with_place(spark, sf_dir)
    placed = placed.withColumns({
        "district": F.lower("district"), "neighborhood": F.lower("neighborhood")})
    key = F.col("o_orderkey")
    constants = [F.lit(f"fixed {name}").alias(name)
                 for name in ("country", "municipality", "province", "url", "thumbnail")]
    parking = F.struct(
        (key % 3 == 1).alias("hasParking"), (key % 5 * 10).alias("parkingPrice"))
    detail = F.struct(
        F.col("o_orderstatus").alias("typology"), F.col("o_orderpriority").alias("subTypology"))
    odd, even = placed.where(key % 2 == 1), placed.where(key % 2 == 0)
    return [
        odd.select(*_listing_columns(), *constants, parking.alias("parkingSpace")),
        even.select(*constants, *_listing_columns(), detail.alias("detailedType")),
    ]


def lookup_district(spark: SparkSession, sf_dir: str, raw: str, name: str) -> DataFrame:
    """All regions but one, so that one misses."""
    region = table(spark, sf_dir, "region").where(F.col("r_regionkey") != 4)
    return region.select(F.lower("r_name").alias(raw), F.col("r_name").alias(name))


def lookup_neighborhood(spark: SparkSession, sf_dir: str, raw: str, name: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 8 != 7)
    return nation.select(F.lower("n_name").alias(raw), F.col("n_name").alias(name))


def lookups(spark: SparkSession, sf_dir: str) -> tuple[Lookup, Lookup]:
    districts = lookup_district(spark, sf_dir, "raw", "name")
    neighborhoods = lookup_neighborhood(spark, sf_dir, "raw", "name")
    return Lookup(districts, "raw", "name"), Lookup(neighborhoods, "raw", "name")


def metrics_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price and participation as exported: text with a decimal comma."""
    metrics = kpis.price_participation(
        listing(spark, sf_dir), income(spark, sf_dir), elections(spark, sf_dir))
    return metrics.withColumns({
        name: decimal_comma_text(F.col(name)) for name in ("avg_price", "participation")})


def correlation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kpis.price_income_correlation(listing(spark, sf_dir), income(spark, sf_dir))
    return rows.withColumn("correlation", decimal_comma_text(F.col("correlation")))


def geometry_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point for every nation that has customers: several shapes per district."""
    homes = table(spark, sf_dir, "customer").select("c_nationkey").distinct()
    placed = _with_place(homes, spark, sf_dir, "c_nationkey")
    shape = F.format_string("POINT(%d %d)", "n_nationkey", "n_regionkey")
    return placed.select(
        F.col("r_regionkey").alias("codi_districte"),
        F.col("district").alias("nom_districte"),
        shape.alias("geometria_wgs84"),
    )


def top_party_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = kpis.top_party_plain(elections(spark, sf_dir))
    votes = F.col("total_votes").cast("bigint").cast("string")
    return rows.select("district", "Party", votes.alias("total_votes"))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with columns that each cleaning step has a reason to drop."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "value",
        "event_type",
        F.when(key % 20 == 0, F.col("value")).alias("sparse"),
        F.lit(1.0).alias("const"),
        F.when(key % 50 == 0, "b").otherwise("a").alias("dominant"),
        F.when(key % 10 != 0, F.col("value")).alias("holey"),
    )
