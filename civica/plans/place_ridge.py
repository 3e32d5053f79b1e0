"""Ridge regression of a price on one category, exactly, for any number of labels.

One-hot columns of one category never overlap, so the normal equations are a diagonal with
one dense row, that of the intercept, and have a closed form in each label's count and
mean. Labels are numbered by a sort over many tasks. Labels, counts and coefficients stay in
a table; the driver sees two rows of sums. The result is that of ``pyspark.ml`` with
an L2 penalty on standardised columns, without its bound on labels or iterations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica import fixed_values as fv
from civica.operators.joins import join_on_keys
from civica.operators.ordering import numbered, stored
from civica.plans.price_model import INDEX, LABEL

PLACE = "neighborhood"


def fit_place_ridge(
    train: DataFrame, place: str = PLACE, label: str = LABEL, penalty: float = fv.MODEL_REGULARISATION
) -> DataFrame:
    """``place, neighborhood_index, coefficient, intercept``: one row for each label.

    Labels are numbered by falling count, then name; the last one is the baseline, whose
    coefficient is zero. Rows without a label or a price are left out; without any row
    the result is empty. A constant price gives zero coefficients.
    """
    rows = train.select(F.col(f"`{place}`").alias(place), F.col(f"`{label}`").cast("double").alias("_y"))
    groups = rows.dropna().groupBy(place).agg(
        F.count(F.lit(1)).alias("_n"), F.avg("_y").alias("_mean"), F.var_pop("_y").alias("_spread"))
    groups = stored(numbered(groups, ["_n", place], out=INDEX, descending=["_n"]), "labels")
    sums = groups.agg(
        F.sum("_n").alias("rows"), F.max(INDEX).alias("last"), F.sum(F.col("_n") * F.col("_mean")).alias("total")).first()
    count, mean = sums["rows"] or 1, (sums["total"] or 0.0) / (sums["rows"] or 1)
    share = F.col("_n") / F.lit(float(count))

    # The variance of all prices from those within and between the labels.
    apart = F.col("_mean") - F.lit(mean)
    variance = groups.agg(F.sum(share * (F.col("_spread") + apart * apart)).alias("v")).first()["v"] or 0.0
    baseline = F.col(INDEX) == F.lit(sums["last"])
    if variance > 0:
        # A label's column has the variance share * (1 - share), by which its penalty is scaled.
        weight = F.lit(penalty / variance ** 0.5) * (1 - share)
        pull = F.when(baseline, 1.0).otherwise(weight / (1 + weight)) * share
        centre = groups.agg((F.sum(pull * F.col("_mean")) / F.sum(pull)).alias("b")).first()["b"]
        coefficient = F.when(baseline, 0.0).otherwise((F.col("_mean") - F.lit(centre)) / (1 + weight))
    else:
        centre, coefficient = mean, F.lit(0.0)
    return groups.select(
        place, F.col(INDEX).cast("double").alias(INDEX), coefficient.alias("coefficient"), F.lit(centre).alias("intercept"))


def score_place_ridge(model: DataFrame, df: DataFrame, *keep: str, place: str = PLACE, label: str = LABEL) -> DataFrame:
    """Predictions next to the actual price and the columns in ``keep``; rows with an unseen
    label, or none, are left out."""
    priced = model.select(place, (F.col("intercept") + F.col("coefficient")).alias("prediction"))
    joined = join_on_keys(df.select(*dict.fromkeys([*keep, place, label])), priced, [place])
    return joined.select(*keep, "prediction", label)
