"""Checks of filters, joins, aggregates, ranks and reconciled datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from civica import fixtures as fx
from civica.checks.registry import check
from civica.checks.shaping import FLAT_LISTING, _flat_listings
from civica.checks.tables import sql
from civica.fixed_values import ELECTORS, MATRIX_COLUMNS, PLACE_KEYS, PSEUDO_PARTIES
from civica.operators import aggregates, filters, joins, moments, ranking
from civica.plans import kpis, reconcile


def _joined(spark, sf):
    return kpis.listings_with_income(fx.listing(spark, sf), fx.income(spark, sf))


@check("filter_eq", sql("SELECT * FROM elections WHERE \"Party\" = 'Electors'", "elections"))
def filter_eq(spark, sf):
    return filters.keep_equal(fx.elections(spark, sf), "Party", ELECTORS)


@check("filter_not_in", sql("""
    SELECT * FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderpriority END
                   AS priority FROM orders)
    WHERE priority NOT IN ('1-URGENT', '5-LOW')"""))
def filter_not_in(spark, sf):
    """Some priorities are NULL; they drop out as well."""
    priority = F.when(F.col("o_orderkey") % 13 != 0, F.col("o_orderpriority"))
    rows = fx.table(spark, sf, "orders").select("o_orderkey", priority.alias("priority"))
    return filters.keep_not_in(rows, "priority", ["1-URGENT", "5-LOW"])


@check("filter_not_null", sql("""
    SELECT event_id, sparse FROM profile WHERE sparse IS NOT NULL""", "profile"))
def filter_not_null(spark, sf):
    return filters.keep_not_null(fx.profile(spark, sf).select("event_id", "sparse"), "sparse")


@check("dropna_any", sql("""
    SELECT event_id, value, holey FROM profile WHERE value IS NOT NULL AND holey IS NOT NULL""",
    "profile"))
def dropna_any(spark, sf):
    return filters.drop_incomplete(fx.profile(spark, sf).select("event_id", "value", "holey"))


@check("lookup_left", sql("""
    SELECT l.property_id, l.price, d.name AS district
    FROM listing l LEFT JOIN lookup_district d ON lower(l.district) = d.raw""",
    "listing", "lookup_district"))
def lookup_left(spark, sf):
    rows = fx.listing(spark, sf).select(
        "property_id", "price", F.lower("district").alias("raw_district"))
    lookup = fx.lookup_district(spark, sf, "raw", "name")
    return joins.attach_lookup(rows, lookup, "raw_district", "raw", "name", "district")


@check("lookup_union", sql(
    FLAT_LISTING.replace("lower(district)", "d.name").replace(
        "FROM listing", "FROM listing l LEFT JOIN lookup_district d ON lower(l.district) = d.raw"),
    "listing", "lookup_district"))
def lookup_union(spark, sf):
    districts, _ = fx.lookups(spark, sf)
    return reconcile.lookup_union(_flat_listings(spark, sf), districts, "district", "district")


@check("join_two_keys", sql("""
    SELECT l.property_id, l.neighborhood, l.district, l.price, e."Party", e."Votes"
    FROM listing l JOIN elections e USING (neighborhood, district)""", "listing", "elections"))
def join_two_keys(spark, sf):
    listing = fx.listing(spark, sf).select("property_id", *PLACE_KEYS, "price")
    return joins.join_on_keys(listing, fx.elections(spark, sf), PLACE_KEYS)


@check("join_one_key", sql("""
    SELECT l.property_id, l.district, p.participation
    FROM listing l JOIN (SELECT district, round(participation, 6) AS participation
                         FROM participation) p USING (district)""",
    "listing", "participation"))
def join_one_key(spark, sf):
    shares = kpis.participation(fx.elections(spark, sf), fx.income(spark, sf))
    listing = fx.listing(spark, sf).select("property_id", "district")
    joined = joins.join_on_keys(listing, shares.select("district", "participation"), ["district"])
    return joined.withColumn("participation", F.round("participation", 6))


@check("avg_by_key", sql("""
    SELECT neighborhood, round(avg(price), 4) AS avg_price FROM listing GROUP BY neighborhood""",
    "listing"))
def avg_by_key(spark, sf):
    rows = aggregates.average_by(fx.listing(spark, sf), ["neighborhood"], "price", "avg_price")
    return rows.withColumn("avg_price", F.round("avg_price", 4))


@check("sum_by_key", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS total
    FROM lineitem GROUP BY ALL""")
def sum_by_key(spark, sf):
    rows = aggregates.sum_by(
        fx.table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity", "total")
    return rows.withColumn("total", F.round("total", 2))


@check("corr_by_key", sql("""
    SELECT neighborhood, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS correlation
    FROM (SELECT neighborhood, corr(price, "priceByArea") AS r FROM listing GROUP BY ALL)""",
    "listing"))
def corr_by_key(spark, sf):
    rows = aggregates.corr_by(
        fx.listing(spark, sf), ["neighborhood"], "price", "priceByArea", "correlation")
    return rows.withColumn("correlation", F.round("correlation", 6))


@check("corr_global", """
    SELECT round(corr(l_quantity, l_extendedprice), 6) AS correlation FROM lineitem""")
def corr_global(spark, sf):
    rows = aggregates.corr_whole(
        fx.table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", "correlation")
    return rows.select(F.round("correlation", 6).alias("correlation"))


def _matrix_sql() -> str:
    cells = [
        f"SELECT '{x}' AS x, '{y}' AS y, corr(\"{x}\", \"{y}\") AS r FROM joined"
        for i, x in enumerate(MATRIX_COLUMNS)
        for y in MATRIX_COLUMNS[i + 1:]
    ]
    body = "\nUNION ALL ".join(cells)
    return sql(
        f"SELECT x, y, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS r FROM ({body})",
        "joined")


@check("corr_matrix", _matrix_sql())
def corr_matrix(spark, sf):
    rows = moments.corr_matrix(_joined(spark, sf), MATRIX_COLUMNS)
    return rows.withColumn("r", F.round("r", 6))


@check("freq_table", """
    SELECT user_id, count(*) AS count FROM events GROUP BY user_id""")
def freq_table(spark, sf):
    return aggregates.frequency(fx.table(spark, sf, "events"), "user_id")


@check("dedup_rows", "SELECT DISTINCT user_id, event_type FROM events")
def dedup_rows(spark, sf):
    return aggregates.deduplicate(fx.table(spark, sf, "events").select("user_id", "event_type"))


@check("collect_by_key", sql("""
    SELECT nom_districte, string_agg(geometria_wgs84, ';' ORDER BY geometria_wgs84) AS shapes
    FROM geometry GROUP BY nom_districte""", "geometry"))
def collect_by_key(spark, sf):
    rows = aggregates.collect_by(
        fx.geometry_text(spark, sf), ["nom_districte"], "geometria_wgs84", "shapes")
    return rows.withColumn("shapes", F.array_join("shapes", ";"))


@check("rank_in_group", sql("""
    SELECT district, "Party", total_votes, CAST(rank() OVER (
        PARTITION BY district ORDER BY total_votes DESC) AS INTEGER) AS rank
    FROM party_votes""", "party_votes"))
def rank_in_group(spark, sf):
    parties = filters.keep_not_in(fx.elections(spark, sf), "Party", PSEUDO_PARTIES)
    votes = aggregates.sum_by(parties, ["district", "Party"], "Votes", "total_votes")
    return ranking.rank_within(votes, ["district"], "total_votes")


@check("rank_hot_group", """
    SELECT o_orderkey, o_orderdate, rank() OVER (ORDER BY o_orderdate DESC) AS rank FROM orders""")
def rank_hot_group(spark, sf):
    """All rows as one group, with many ties."""
    return ranking.rank_spread(fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), [], "o_orderdate")


@check("collect_chunks", """
    SELECT o_orderstatus, (place // 1000)::BIGINT AS chunk, count(*) AS n,
           string_agg(o_custkey, ',' ORDER BY o_custkey) AS customers
    FROM (SELECT o_orderstatus, o_custkey,
                 row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey) - 1 AS place FROM orders)
    GROUP BY o_orderstatus, chunk""")
def collect_chunks(spark, sf):
    """The customers of all orders of a state, a list for every 1000."""
    lists = aggregates.collect_chunks(
        fx.table(spark, sf, "orders"), ["o_orderstatus"], "o_custkey", "customers", size=1000)
    return lists.select(
        "o_orderstatus", "chunk", F.size("customers").cast("bigint").alias("n"),
        F.array_join("customers", ",").alias("customers"))


@check("top_in_group", """
    SELECT * FROM (SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(rank() OVER (
        PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS INTEGER) AS rank FROM orders)
    WHERE rank <= 3""")
def top_in_group(spark, sf):
    orders = fx.table(spark, sf, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice")
    return ranking.top_within(orders, ["o_orderpriority"], "o_totalprice", k=3)


# Sizes are whole numbers, so their sums are exact in any order.
@check("sorted_kpi", sql("""
    SELECT district, neighborhood, avg(size) AS avg_size FROM listing
    GROUP BY district, neighborhood ORDER BY avg_size DESC, neighborhood""", "listing"))
def sorted_kpi(spark, sf):
    rows = aggregates.average_by(
        fx.listing(spark, sf), ["district", "neighborhood"], "size", "avg_size")
    return ranking.order_descending(rows, "avg_size", ["neighborhood"])


@check("reconcile_income", sql("""
    SELECT d.name AS district, n.name AS neighborhood, "RFD", pop, year
    FROM raw_income r
    LEFT JOIN lookup_district d ON r.district_name = d.raw
    LEFT JOIN lookup_neighborhood n ON r."neigh_name " = n.raw""",
    "raw_income", "lookup_district", "lookup_neighborhood"))
def reconcile_income(spark, sf):
    return reconcile.reconcile_income([fx.raw_income(spark, sf)], *fx.lookups(spark, sf))


@check("reconcile_elections", sql("""
    SELECT d.name AS district, n.name AS neighborhood, "Party",
           CAST(CAST("Votes" AS BIGINT) AS VARCHAR) AS "Votes"
    FROM elections e
    LEFT JOIN lookup_district d ON lower(e.district) = d.raw
    LEFT JOIN lookup_neighborhood n ON lower(e.neighborhood) = n.raw""",
    "elections", "lookup_district", "lookup_neighborhood"))
def reconcile_elections(spark, sf):
    return reconcile.reconcile_elections(fx.raw_elections(spark, sf), *fx.lookups(spark, sf))


RECONCILED_LISTING = FLAT_LISTING.replace("lower(district)", "d.name").replace(
    "lower(neighborhood)", "n.name").replace("FROM listing", """FROM listing l
    LEFT JOIN lookup_district d ON lower(l.district) = d.raw
    LEFT JOIN lookup_neighborhood n ON lower(l.neighborhood) = n.raw""")


@check("reconcile_listings", sql(
    RECONCILED_LISTING, "listing", "lookup_district", "lookup_neighborhood"))
def reconcile_listings(spark, sf):
    return reconcile.reconcile_listings(fx.raw_listings(spark, sf), *fx.lookups(spark, sf))


# Normalised names lose their underscore, so the lookup lists them without it.
@check("reconcile_listings_normalized", sql(
    RECONCILED_LISTING, "listing", "lookup_district", "lookup_neighborhood"))
def reconcile_listings_normalized(spark, sf):
    districts, neighborhoods = fx.lookups(spark, sf)
    plain = neighborhoods.frame.withColumn("raw", F.replace(F.col("raw"), F.lit("_"), F.lit("")))
    neighborhoods = reconcile.Lookup(plain, "raw", "name")
    return reconcile.reconcile_listings(
        fx.raw_listings(spark, sf), districts, neighborhoods, normalize=True)
