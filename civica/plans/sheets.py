"""The tables behind the four dashboard sheets.

Inputs are the exported results: text columns with a decimal comma, district shapes as
text, and the top parties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica import fixed_values as fv
from civica.functions.numbers import map_values, parse_decimal_comma, percentage, step_class
from civica.operators.aggregates import collect_by
from civica.operators.filters import keep_not_null

SHAPE = "geometria_wgs84"
NAME = "nom_districte"


def dashboard_join(metrics: DataFrame, geometry: DataFrame, parties: DataFrame) -> DataFrame:
    """Metrics with the shapes and the top parties of their district, inner on the name.

    The shapes of a district and its tied parties multiply, as in the dashboard.
    """
    shapes = geometry.withColumn("district", F.col(NAME))
    votes = parties.select("district", "Party", "total_votes")
    return metrics.join(shapes, "district").join(votes, "district")


def dashboard_relate(dashboard: DataFrame, correlations: DataFrame) -> DataFrame:
    """Metrics of each district on the dashboard, with all its correlations.

    Takes the joined rows, so a district without a shape or a winning party does not
    appear. Rows that the join only repeated come once; a district without a
    correlation keeps its row.
    """
    metrics = dashboard.select("district", "avg_price", "participation").distinct()
    return metrics.join(correlations.select("district", "correlation"), "district", "left")


def sheet_price(dashboard: DataFrame) -> DataFrame:
    """Average price and shapes per district."""
    priced = dashboard.withColumn("price", parse_decimal_comma(F.col("avg_price")))
    return collect_by(keep_not_null(priced, NAME), [NAME, "price"], SHAPE, "shapes")


def sheet_participation(dashboard: DataFrame) -> DataFrame:
    """Sum of the participation percentage, and shapes, per district.

    As on the sheet, the sum runs over the joined rows.
    """
    share = percentage(parse_decimal_comma(F.col("participation")))
    known = keep_not_null(dashboard.withColumn("participation", share), NAME)
    return collect_by(known, [NAME], SHAPE, "shapes", sums=["participation"])


def sheet_correlation(related: DataFrame) -> DataFrame:
    """Correlations per district with the step of the colour scale they fall in.

    The correlation is a dimension of the sheet: each value of a district is one row.
    """
    value = parse_decimal_comma(F.col("correlation"))
    parsed = related.select("district", value.alias("correlation")).distinct()
    return parsed.withColumn("step", step_class(F.col("correlation")))


def sheet_party(dashboard: DataFrame, colours: dict[str, str] = fv.PARTY_COLOURS) -> DataFrame:
    """Winning parties with their votes, colour and the shapes they won."""
    shapes = collect_by(dashboard, ["Party", "total_votes"], SHAPE, "shapes")
    return shapes.withColumn("colour", map_values(F.col("Party"), colours))
