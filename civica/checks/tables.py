"""The fixtures of ``civica.fixtures`` as SQL common table expressions."""

from __future__ import annotations

CTES = {
    "listing": """
        SELECT r_name AS district, n_name AS neighborhood, o_orderkey AS property_id,
               o_totalprice AS price, CAST(o_orderkey % 4 + 1 AS DOUBLE) AS bathrooms,
               CAST(20 + o_orderkey % 180 AS DOUBLE) AS size,
               o_totalprice / CAST(20 + o_orderkey % 180 AS DOUBLE) AS "priceByArea",
               o_orderstatus, o_orderpriority
        FROM orders
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "income": """
        SELECT r_name AS district, n_name AS neighborhood,
               round(avg(s_acctbal), 4) AS "RFD", count(*) AS pop
        FROM supplier
        JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name""",
    "elections": """
        SELECT r_name AS district, n_name AS neighborhood,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Electors' WHEN 'AUTOMOBILE' THEN 'PP'
                    WHEN 'BUILDING' THEN 'PSC' WHEN 'MACHINERY' THEN 'CAT-JUNTS+'
                    ELSE c_mktsegment END AS "Party",
               CAST(count(*) AS DOUBLE) AS "Votes"
        FROM customer
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        GROUP BY ALL""",
    "yearly": """
        SELECT s_nationkey, CAST(2011 + s_suppkey % 4 AS INTEGER) AS year,
               max(s_acctbal) AS rfd, CAST(count(*) AS INTEGER) AS pop
        FROM supplier GROUP BY ALL""",
    "raw_income": """
        SELECT n_nationkey AS _id, lower(r_name) AS district_name,
               lower(n_name) AS "neigh_name ", arg_min(rfd, year) AS "RFD",
               arg_min(pop, year) AS pop, min(year) AS year
        FROM nation
        JOIN region ON n_regionkey = r_regionkey
        LEFT JOIN yearly ON n_nationkey = s_nationkey
        GROUP BY ALL""",
    "lookup_district": """
        SELECT lower(r_name) AS raw, r_name AS name FROM region WHERE r_regionkey <> 4""",
    "lookup_neighborhood": """
        SELECT lower(n_name) AS raw, n_name AS name FROM nation WHERE n_nationkey % 8 <> 7""",
    "joined": """
        SELECT l.*, i."RFD", i.pop FROM listing l JOIN income i USING (neighborhood, district)""",
    "price_district": """
        SELECT district, avg(price) AS avg_price FROM joined GROUP BY district""",
    "participation": """
        SELECT district, "TotalVotes", total_population,
               "TotalVotes" / total_population AS participation
        FROM (SELECT district, sum("Votes") AS "TotalVotes" FROM elections
              WHERE "Party" = 'Electors' GROUP BY district)
        JOIN (SELECT district, CAST(sum(pop) AS DOUBLE) AS total_population
              FROM income GROUP BY district) USING (district)""",
    "price_participation": """
        SELECT district, avg_price, participation
        FROM price_district JOIN participation USING (district)""",
    "correlation": """
        SELECT district, CASE WHEN isnan(r) THEN NULL ELSE r END AS correlation
        FROM (SELECT district, corr(price, "RFD") AS r FROM joined GROUP BY district)""",
    "party_votes": """
        SELECT district, "Party", sum("Votes") AS total_votes FROM elections
        WHERE "Party" NOT IN ('Electors', 'Votants', 'Vots vàlids') GROUP BY ALL""",
    "top_party": """
        SELECT district, "Party", total_votes, rank FROM (
            SELECT *, CAST(rank() OVER (PARTITION BY district ORDER BY total_votes DESC)
                           AS INTEGER) AS rank FROM party_votes) WHERE rank = 1""",
    "metrics_text": """
        SELECT district,
               replace(CAST(CAST(round(avg_price, 4) AS DECIMAL(30, 4)) AS VARCHAR),
                       '.', ',') AS avg_price,
               replace(CAST(CAST(round(participation, 4) AS DECIMAL(30, 4)) AS VARCHAR),
                       '.', ',') AS participation
        FROM price_participation""",
    "correlation_text": """
        SELECT district,
               replace(CAST(CAST(round(correlation, 4) AS DECIMAL(30, 4)) AS VARCHAR),
                       '.', ',') AS correlation
        FROM correlation""",
    "geometry": """
        SELECT r_regionkey AS codi_districte, r_name AS nom_districte,
               'POINT(' || n_nationkey || ' ' || n_regionkey || ')' AS geometria_wgs84
        FROM (SELECT DISTINCT c_nationkey FROM customer)
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "dashboard": """
        SELECT m.*, g.codi_districte, g.nom_districte, g.geometria_wgs84, p."Party",
               CAST(CAST(p.total_votes AS BIGINT) AS VARCHAR) AS total_votes
        FROM metrics_text m
        JOIN geometry g ON m.district = g.nom_districte
        JOIN top_party p ON m.district = p.district""",
    "profile": """
        SELECT event_id, value, event_type,
               CASE WHEN event_id % 20 = 0 THEN value END AS sparse,
               CAST(1.0 AS DOUBLE) AS const,
               CASE WHEN event_id % 50 = 0 THEN 'b' ELSE 'a' END AS dominant,
               CASE WHEN event_id % 10 <> 0 THEN value END AS holey
        FROM events""",
    "split_listing": """
        SELECT *, CASE WHEN CAST('0x' || substr(md5(CAST(property_id AS VARCHAR)), 1, 8)
                                 AS UBIGINT) % 100 < 70 THEN 'train' ELSE 'test' END AS part
        FROM joined""",
    # Ridge regression on one-hot columns has a closed form: every group mean is
    # drawn towards the intercept by its weight against the penalty; the least
    # frequent label is the baseline and has no coefficient.
    "groups": """
        SELECT neighborhood, count(*) AS n, avg(price) AS mean,
               count(*) / sum(count(*)) OVER () AS p,
               row_number() OVER (ORDER BY count(*) DESC, neighborhood) - 1 AS idx,
               count(*) OVER () AS labels
        FROM split_listing WHERE part = 'train' GROUP BY neighborhood""",
    "penalty": """
        SELECT 0.1 / stddev_pop(price) AS strength FROM split_listing WHERE part = 'train'""",
    "shrunk": """
        SELECT *, CASE WHEN idx = labels - 1 THEN 0.0
                       ELSE p / (p + strength * p * (1 - p)) END AS keep
        FROM groups CROSS JOIN penalty""",
    "base": """
        SELECT sum(p * (1 - keep) * mean) / sum(p * (1 - keep)) AS intercept FROM shrunk""",
    "model": """
        SELECT neighborhood, CAST(idx AS DOUBLE) AS neighborhood_index,
               CASE WHEN keep = 0 THEN 0.0 ELSE keep * (mean - intercept) END AS coefficient,
               intercept,
               intercept + keep * (mean - intercept) AS prediction
        FROM shrunk CROSS JOIN base""",
    "scored": """
        SELECT s.*, m.prediction FROM split_listing s JOIN model m USING (neighborhood)""",
}

NEEDS = {
    "raw_income": ["yearly"],
    "joined": ["listing", "income"],
    "price_district": ["joined"],
    "participation": ["elections", "income"],
    "price_participation": ["price_district", "participation"],
    "correlation": ["joined"],
    "party_votes": ["elections"],
    "top_party": ["party_votes"],
    "metrics_text": ["price_participation"],
    "correlation_text": ["correlation"],
    "dashboard": ["metrics_text", "geometry", "top_party"],
    "split_listing": ["joined"],
    "groups": ["split_listing"],
    "penalty": ["split_listing"],
    "shrunk": ["groups", "penalty"],
    "base": ["shrunk"],
    "model": ["shrunk", "base"],
    "scored": ["split_listing", "model"],
}


def _ordered(name: str, seen: list[str]) -> list[str]:
    for need in NEEDS.get(name, []):
        _ordered(need, seen)
    if name not in seen:
        seen.append(name)
    return seen


def sql(body: str, *names: str) -> str:
    """``body`` with the named tables, and what they need, defined before it."""
    seen: list[str] = []
    for name in names:
        _ordered(name, seen)
    if not seen:
        return body
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in seen) + "\n" + body
