"""Checks of readers, writers and the batch run: data is written, then read again."""

from __future__ import annotations

from pyspark.sql import functions as F

from civica import fixtures as fx
from civica.checks.registry import check
from civica.checks.tables import sql
from civica.plans import batch, kpis
from civica.session import scratch_path
from civica.sources import collections, exports, files


def _write(df, path, fmt, **options):
    df.write.format(fmt).options(**options).save(path)


@check("load_formats", """
    SELECT 'json' AS format, CAST(s_suppkey AS VARCHAR) AS key, s_name AS name FROM supplier
    UNION ALL SELECT 'csv', CAST(c_custkey AS VARCHAR), c_name FROM customer
    UNION ALL SELECT 'parquet', CAST(p_partkey AS VARCHAR), p_name FROM part""")
def load_formats(spark, sf):
    """Three formats in one folder, next to a file of a kind that is skipped."""
    folder = scratch_path(spark, "load_formats")
    _write(fx.table(spark, sf, "supplier"), f"{folder}/supplier.json", "json")
    _write(fx.table(spark, sf, "customer"), f"{folder}/customer.csv", "csv", header=True, sep=";")
    _write(fx.table(spark, sf, "part"), f"{folder}/part.parquet", "parquet")
    _write(fx.table(spark, sf, "region"), f"{folder}/region.orc", "orc")
    frames = files.load_files(spark, folder, schemas={"json": "s_suppkey bigint, s_name string"})
    columns = {
        "supplier.json": ("s_suppkey", "s_name"),
        "customer.csv": ("c_custkey", "c_name"),
        "part.parquet": ("p_partkey", "p_name"),
    }
    rows = [
        frame.select(
            F.lit(name.split(".")[1]).alias("format"),
            F.col(columns[name][0]).cast("string").alias("key"),
            F.col(columns[name][1]).alias("name"))
        for name, frame in frames.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def _write_snapshots(spark, sf, folder):
    odd, even = fx.raw_listings(spark, sf)
    _write(odd, f"{folder}/2020_01", "parquet")
    _write(even, f"{folder}/2020_02", "parquet")


SNAPSHOT_SQL = sql("""
    SELECT CASE WHEN property_id % 2 = 1 THEN '2020_01' ELSE '2020_02' END AS snapshot,
           property_id, price,
           CASE WHEN property_id % 2 = 1 THEN property_id % 5 * 10 END AS "parkingPrice",
           CASE WHEN property_id % 2 = 0 THEN o_orderstatus END AS typology FROM listing""",
    "listing")


def _snapshot_columns(df):
    return df.select(
        "snapshot", "property_id", "price", "parkingSpace.parkingPrice", "detailedType.typology")


@check("collection_lifecycle", "SELECT n_nationkey, n_name, 'kept' AS name FROM nation")
def collection_lifecycle(spark, sf):
    """Created twice and filled; another one filled, dropped twice and created again."""
    store, schema = scratch_path(spark, "lifecycle"), "n_nationkey bigint, n_name string"
    nations = fx.table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint"), "n_name")
    for name in ("kept", "gone"):
        collections.create_collection(spark, name, schema, store)
        collections.write_collection(nations, name, store)
        collections.create_collection(spark, name, schema, store)
    for _ in range(2):
        collections.drop_collection(spark, "gone", store)
    collections.create_collection(spark, "gone", schema, store)
    found = collections.read_collections(spark, ["kept", "gone"], store)
    return found["kept"].withColumn("name", F.lit("kept")).unionByName(found["gone"].withColumn("name", F.lit("gone")))


@check("load_snapshots", SNAPSHOT_SQL)
def load_snapshots(spark, sf):
    folder = scratch_path(spark, "load_snapshots")
    _write_snapshots(spark, sf, folder)
    return _snapshot_columns(files.load_snapshots(spark, folder))


@check("parquet_to_json", SNAPSHOT_SQL)
def parquet_to_json(spark, sf):
    source, target = scratch_path(spark, "json_source"), scratch_path(spark, "json_target")
    _write_snapshots(spark, sf, source)
    exports.parquet_to_json(spark, source, target)
    schema = files.load_snapshots(spark, source).schema
    return _snapshot_columns(files.read_json(spark, target, schema))


@check("csv_to_json", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, o_orderstatus,
           CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_custkey AS VARCHAR) END AS o_custkey
    FROM orders""")
def csv_to_json(spark, sf):
    """Files that share a header, have its columns in another order, or one more."""
    source, target = scratch_path(spark, "csv_source"), scratch_path(spark, "csv_target")
    orders = fx.table(spark, sf, "orders")
    columns = ["o_orderkey", "o_orderpriority", "o_orderstatus"]
    for rest, header in enumerate([columns, columns[::-1], [columns[0], "o_custkey", *columns[1:]]]):
        part = orders.where(F.col("o_orderkey") % 3 == rest).select(*header).repartition(2)
        part.write.mode("append").option("header", True).csv(source)
    exports.csv_to_json(spark, source, target)
    schema = "o_orderkey string, o_orderpriority string, o_orderstatus string, o_custkey string"
    return files.read_json(spark, target, schema).drop("file")


@check("read_tables", """
    SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""")
def read_tables(spark, sf):
    store = scratch_path(spark, "store")
    for name in ("orders", "customer"):
        collections.write_collection(fx.table(spark, sf, name), name, store)
    frames = collections.read_collections(spark, ["orders", "customer"], store)
    files.register(frames, prefix="stored_")
    rows = spark.sql("""
        SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM stored_orders JOIN stored_customer ON o_custkey = c_custkey
        GROUP BY c_mktsegment""")
    return rows


def _orders(spark, sf):
    return fx.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")


@check("write_append", """
    SELECT o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders""")
def write_append(spark, sf):
    store = scratch_path(spark, "append")
    for _ in range(2):
        collections.write_collection(_orders(spark, sf), "orders", store, append=True)
    return collections.read_collections(spark, ["orders"], store)["orders"]


@check("write_replace", "SELECT o_orderkey, o_totalprice FROM orders")
def write_replace(spark, sf):
    store = scratch_path(spark, "replace")
    for _ in range(2):
        collections.write_collection(_orders(spark, sf), "orders", store, append=False)
    return collections.read_collections(spark, ["orders"], store)["orders"]


def _price_kpi(spark, sf):
    rows = kpis.average_price(fx.listing(spark, sf), fx.income(spark, sf), by="neighborhood")
    return rows.withColumn("avg_price", F.round("avg_price", 2))


PRICE_KPI_SQL = sql("""
    SELECT neighborhood, round(avg(price), 2) AS avg_price FROM joined GROUP BY neighborhood""",
    "joined")
PRICE_KPI_SCHEMA = "neighborhood string, avg_price double"


@check("export_csv", PRICE_KPI_SQL)
def export_csv(spark, sf):
    path = scratch_path(spark, "export_csv")
    exports.export_csv(_price_kpi(spark, sf), path, order=["neighborhood"])
    return files.read_csv(spark, path, ",", PRICE_KPI_SCHEMA)


@check("publish_kpis", PRICE_KPI_SQL)
def publish_kpis(spark, sf):
    path, store = scratch_path(spark, "kpi_csv"), scratch_path(spark, "exploitation")
    exports.export_csv(_price_kpi(spark, sf), path)
    exports.publish_csv(spark, path, "kpi1", store, PRICE_KPI_SCHEMA)
    return collections.read_collections(spark, ["kpi1"], store)["kpi1"]


@check("sample_head", sql("""
    SELECT property_id, district, neighborhood, price FROM listing
    ORDER BY property_id LIMIT 100""", "listing"))
def sample_head(spark, sf):
    path = scratch_path(spark, "sample_head")
    listing = fx.listing(spark, sf).select("property_id", "district", "neighborhood", "price")
    exports.export_head(listing, path, order=["property_id"], rows=100)
    schema = "property_id bigint, district string, neighborhood string, price double"
    return files.read_csv(spark, path, ",", schema)


@check("output_all", sql("""
    SELECT property_id, district, neighborhood, price FROM listing""", "listing"))
def output_all(spark, sf):
    path = scratch_path(spark, "output_all")
    listing = fx.listing(spark, sf).select("property_id", "district", "neighborhood", "price")
    exports.export_all(listing, path)
    schema = "property_id bigint, district string, neighborhood string, price double"
    return files.read_csv(spark, path, ",", schema)


def _raw_zone(spark, sf) -> batch.RawZone:
    """The fixtures written out as the raw files that the batch run expects."""
    base = scratch_path(spark, "raw_zone")
    zone = batch.RawZone(
        f"{base}/listings", f"{base}/income", f"{base}/elections", f"{base}/lookups")
    _write_snapshots(spark, sf, zone.listings)
    _write(fx.raw_income(spark, sf), f"{zone.income}/2011.json", "json")
    for number, frame in enumerate(fx.raw_elections(spark, sf)):
        _write(frame, f"{zone.elections}/part{number}.csv", "csv", header=True, sep=";")
    for file, raw, name in batch.LOOKUPS:
        make = fx.lookup_district if "district" in file else fx.lookup_neighborhood
        _write(make(spark, sf, raw, name), f"{zone.lookups}/{file}", "json")
    return zone


BATCH_NAMES = """
    LEFT JOIN lookup_district d ON lower({}) = d.raw LEFT JOIN lookup_neighborhood n ON lower({}) = n.raw"""


@check("batch_tables", sql(f"""
    SELECT * FROM (
    WITH l AS (
        SELECT d.name AS district, n.name AS neighborhood, property_id, price
        FROM listing l {BATCH_NAMES.format("l.district", "l.neighborhood")}),
    i AS (
        SELECT DISTINCT d.name AS district, n.name AS neighborhood, "RFD", pop, year
        FROM raw_income r {BATCH_NAMES.format("r.district_name", 'r."neigh_name "')}),
    e AS (
        SELECT DISTINCT d.name AS district, n.name AS neighborhood, "Party", "Votes"
        FROM elections e {BATCH_NAMES.format("e.district", "e.neighborhood")}),
    j AS (SELECT l.*, i."RFD" FROM l JOIN i USING (neighborhood, district)),
    share AS (
        SELECT district, votes / people AS participation
        FROM (SELECT district, sum("Votes") AS votes FROM e WHERE "Party" = 'Electors' GROUP BY district)
        JOIN (SELECT district, sum(pop) AS people FROM i GROUP BY district) USING (district)),
    won AS (
        SELECT *, rank() OVER (PARTITION BY district ORDER BY votes DESC) AS place
        FROM (SELECT district, "Party", sum("Votes") AS votes FROM l JOIN e USING (neighborhood, district)
              WHERE "Party" NOT IN ('Electors', 'Votants', 'Vots vàlids') GROUP BY ALL)),
    priced AS (SELECT district, avg(price) AS avg_price FROM j GROUP BY district)
    SELECT 'listings' AS collection, NULL AS name, count(*) AS n, NULL AS figure FROM l
    UNION ALL SELECT 'income', NULL, count(*), NULL FROM i
    UNION ALL SELECT 'elections', NULL, count(*), NULL FROM e
    UNION ALL SELECT 'predictive_data', NULL, count(*), round(avg(price), 4) FROM j
    UNION ALL SELECT 'avgprice_district', district, NULL, round(avg_price, 4) FROM priced
    UNION ALL SELECT 'avgprice_neighborhood', neighborhood, NULL, round(avg(price), 4) FROM j GROUP BY neighborhood
    UNION ALL SELECT 'kpi1', district, NULL, round(avg_price, 4) FROM priced JOIN share USING (district)
    UNION ALL SELECT 'kpi1 participation', district, NULL, round(participation, 6)
              FROM priced JOIN share USING (district)
    UNION ALL SELECT 'kpi2', district, NULL, round(CASE WHEN NOT isnan(r) THEN r END, 6)
              FROM (SELECT district, corr(price, "RFD") AS r FROM j GROUP BY district)
    UNION ALL SELECT 'kpi3', district || ' ' || "Party", NULL, round(votes, 2) FROM won WHERE place = 1)""",
    "listing", "raw_income", "elections", "lookup_district", "lookup_neighborhood"))
def batch_tables(spark, sf):
    """The batch run from raw files to stored results: rows of the formatted collections and
    every figure of the results."""
    formatted, results = scratch_path(spark, "formatted"), scratch_path(spark, "results")
    batch.run_batch(spark, _raw_zone(spark, sf), formatted, results)
    stored = collections.read_collections(spark, batch.FORMATTED, formatted)
    published = collections.read_collections(spark, [*batch.KPI_SCHEMAS, "predictive_data"], results)
    rows = [
        frame.agg(
            F.lit(name).alias("collection"), F.lit(None).cast("string").alias("name"),
            F.count(F.lit(1)).alias("n"), figure.cast("double").alias("figure"))
        for name, frame, figure in [
            *[(name, frame, F.lit(None)) for name, frame in stored.items()],
            ("predictive_data", published["predictive_data"], F.round(F.avg("price"), 4))]
    ]
    figures = {
        "avgprice_district": ("avgprice_district", F.col("district"), F.round("avg_price", 4)),
        "avgprice_neighborhood": ("avgprice_neighborhood", F.col("neighborhood"), F.round("avg_price", 4)),
        "kpi1": ("kpi1", F.col("district"), F.round("avg_price", 4)),
        "kpi1 participation": ("kpi1", F.col("district"), F.round("participation", 6)),
        "kpi2": ("kpi2", F.col("district"), F.round("correlation", 6)),
        "kpi3": ("kpi3", F.concat_ws(" ", "district", "Party"), F.round("total_votes", 2)),
    }
    rows += [
        published[table].select(
            F.lit(name).alias("collection"), key.alias("name"), F.lit(None).cast("bigint").alias("n"),
            figure.alias("figure"))
        for name, (table, key, figure) in figures.items()
    ]
    result = rows[0]
    for more in rows[1:]:
        result = result.unionByName(more)
    return result
