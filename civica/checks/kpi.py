"""Checks of the key figures and the dashboard sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from civica import fixtures as fx
from civica.checks.registry import check
from civica.checks.tables import sql
from civica.plans import kpis, sheets


def _inputs(spark, sf):
    return fx.listing(spark, sf), fx.income(spark, sf), fx.elections(spark, sf)


@check("kpi_price_district", sql("""
    SELECT district, round(avg_price, 4) AS avg_price FROM price_district""", "price_district"))
def price_district(spark, sf):
    listing, income, _ = _inputs(spark, sf)
    return kpis.average_price(listing, income).withColumn("avg_price", F.round("avg_price", 4))


@check("kpi_price_neighborhood", sql("""
    SELECT neighborhood, round(avg(price), 4) AS avg_price FROM joined GROUP BY neighborhood""",
    "joined"))
def price_neighborhood(spark, sf):
    listing, income, _ = _inputs(spark, sf)
    rows = kpis.average_price(listing, income, by="neighborhood")
    return rows.withColumn("avg_price", F.round("avg_price", 4))


@check("kpi_price_income_corr", sql("""
    SELECT district, round(correlation, 6) AS correlation FROM correlation""", "correlation"))
def price_income_corr(spark, sf):
    listing, income, _ = _inputs(spark, sf)
    rows = kpis.price_income_correlation(listing, income)
    return rows.withColumn("correlation", F.round("correlation", 6))


@check("kpi_top_party_weighted", sql("""
    SELECT district, "Party", total_votes, rank FROM (
        SELECT *, CAST(rank() OVER (PARTITION BY district ORDER BY total_votes DESC)
                       AS INTEGER) AS rank
        FROM (SELECT district, "Party", sum("Votes") AS total_votes
              FROM listing JOIN elections USING (neighborhood, district)
              WHERE "Party" NOT IN ('Electors', 'Votants', 'Vots vàlids') GROUP BY ALL))
    WHERE rank = 1""", "listing", "elections"))
def top_party_weighted(spark, sf):
    listing, _, elections = _inputs(spark, sf)
    return kpis.top_party_weighted(listing, elections)


@check("kpi_top_party_plain", sql("SELECT * FROM top_party", "top_party"))
def top_party_plain(spark, sf):
    return kpis.top_party_plain(fx.elections(spark, sf))


@check("kpi_participation", sql("""
    SELECT district, "TotalVotes", total_population, round(participation, 6) AS participation
    FROM participation""", "participation"))
def participation(spark, sf):
    rows = kpis.participation(fx.elections(spark, sf), fx.income(spark, sf))
    return rows.withColumn("participation", F.round("participation", 6))


@check("kpi_price_participation", sql("""
    SELECT district, round(avg_price, 4) AS avg_price, round(participation, 6) AS participation
    FROM price_participation""", "price_participation"))
def price_participation(spark, sf):
    rows = kpis.price_participation(*_inputs(spark, sf))
    return rows.withColumns({
        "avg_price": F.round("avg_price", 4), "participation": F.round("participation", 6)})


@check("kpi_price_participation_corr", sql("""
    SELECT round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS correlation
    FROM (SELECT corr(avg_price, participation) AS r FROM price_participation)""",
    "price_participation"))
def price_participation_corr(spark, sf):
    rows = kpis.price_participation_correlation(*_inputs(spark, sf))
    return rows.withColumn("correlation", F.round("correlation", 6))


def _dashboard(spark, sf):
    return sheets.dashboard_join(
        fx.metrics_text(spark, sf), fx.geometry_text(spark, sf), fx.top_party_text(spark, sf))


def _related(spark, sf):
    return sheets.dashboard_relate(_dashboard(spark, sf), fx.correlation_text(spark, sf))


def _shapes_as_text(df):
    return df.withColumn("shapes", F.array_join("shapes", ";"))


@check("dashboard_join", sql("SELECT * FROM dashboard", "dashboard"))
def dashboard_join(spark, sf):
    return _dashboard(spark, sf)


@check("dashboard_relate", sql("""
    SELECT m.district, m.avg_price, m.participation, c.correlation
    FROM metrics_text m LEFT JOIN correlation_text c USING (district)""",
    "metrics_text", "correlation_text"))
def dashboard_relate(spark, sf):
    return _related(spark, sf)


SHAPES = "string_agg(geometria_wgs84, ';' ORDER BY geometria_wgs84) AS shapes"


@check("sheet_price", sql(f"""
    SELECT nom_districte, CAST(replace(avg_price, ',', '.') AS DOUBLE) AS price, {SHAPES}
    FROM dashboard WHERE nom_districte IS NOT NULL GROUP BY nom_districte, avg_price""",
    "dashboard"))
def sheet_price(spark, sf):
    return _shapes_as_text(sheets.sheet_price(_dashboard(spark, sf)))


@check("sheet_participation", sql(f"""
    SELECT nom_districte, round(sum(CAST(replace(participation, ',', '.') AS DOUBLE) * 100), 4)
           AS participation, {SHAPES}
    FROM dashboard WHERE nom_districte IS NOT NULL GROUP BY nom_districte""", "dashboard"))
def sheet_participation(spark, sf):
    rows = sheets.sheet_participation(_dashboard(spark, sf))
    return _shapes_as_text(rows).withColumn("participation", F.round("participation", 4))


@check("sheet_correlation", sql("""
    SELECT district, r AS correlation, CASE WHEN r IS NOT NULL THEN
           CAST(least(floor((r + 1) / 2 * 7) + 1, 7) AS BIGINT) END AS step
    FROM (SELECT m.district, CAST(replace(c.correlation, ',', '.') AS DOUBLE) AS r
          FROM metrics_text m LEFT JOIN correlation_text c USING (district))""",
    "metrics_text", "correlation_text"))
def sheet_correlation(spark, sf):
    rows = sheets.sheet_correlation(_related(spark, sf))
    return rows.withColumn("step", F.col("step").cast("bigint"))


@check("sheet_party", sql(f"""
    SELECT "Party", total_votes, CASE "Party" WHEN 'PP' THEN '#4e79a7'
           WHEN 'CAT-JUNTS+' THEN '#76b7b2' WHEN 'PSC' THEN '#e15759' END AS colour, {SHAPES}
    FROM dashboard GROUP BY "Party", total_votes""", "dashboard"))
def sheet_party(spark, sf):
    return _shapes_as_text(sheets.sheet_party(_dashboard(spark, sf)))
