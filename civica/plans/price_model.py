"""Predicting listing prices from the neighbourhood."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica import fixed_values as fv

INDEX = "neighborhood_index"
FEATURES = "neighborhood_vector"
LABEL = "price"
PART = "part"


def with_split(
    df: DataFrame, key: str, percent: int = fv.TRAIN_PERCENT, out: str = PART
) -> DataFrame:
    """Mark each row ``train`` or ``test`` by a hash of its key.

    A row's part depends on its key alone, so it is the same in every run and for any
    partitioning of the data. A row without a key raises when it is read.
    """
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    slot = F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(100))
    missing = F.raise_error(F.lit(f"a row without {key} can't be split"))
    part = F.when(F.col(key).isNull(), missing).when(slot < percent, "train").otherwise("test")
    return df.withColumn(out, part)


def split(df: DataFrame, key: str, percent: int = fv.TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, key, percent, PART)
    train, test = (marked.where(F.col(PART) == part) for part in ("train", "test"))
    return train.drop(PART), test.drop(PART)


def stored_split(
    df: DataFrame, key: str, path: str, percent: int = fv.TRAIN_PERCENT
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, written to ``path`` once and read from there.

    Fitting passes over the training rows several times. Read from a table, each pass
    costs a scan of the columns it needs, in the files of its part, instead of the joins
    that made the rows.
    """
    with_split(df, key, percent, PART).write.mode("overwrite").partitionBy(PART).parquet(path)
    stored = df.sparkSession.read.parquet(path)
    train, test = (stored.where(F.col(PART) == part) for part in ("train", "test"))
    return train.drop(PART), test.drop(PART)


def label_indexer() -> StringIndexer:
    """Most frequent label first, ties by name; rows with an unseen label are skipped."""
    return StringIndexer(inputCol="neighborhood", outputCol=INDEX, handleInvalid="skip")


def fit_price_model(train: DataFrame) -> PipelineModel:
    """Index and one-hot encode the neighbourhood, then fit a ridge regression.

    Both fits are single aggregations over the two columns used. Rows without a price
    cannot be learned from and are left out.
    """
    regression = LinearRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        maxIter=fv.MODEL_ITERATIONS,
        regParam=fv.MODEL_REGULARISATION,
    )
    encoder = OneHotEncoder(inputCol=INDEX, outputCol=FEATURES)
    pipeline = Pipeline(stages=[label_indexer(), encoder, regression])
    return pipeline.fit(train.select("neighborhood", LABEL).dropna(subset=[LABEL]))


def score(model: PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """Predictions next to the actual price and the columns in ``keep``."""
    return model.transform(df).select(*keep, "prediction", LABEL)


def coefficients(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Index, coefficient and intercept per neighbourhood of ``df``.

    The least frequent label is the baseline; its coefficient is zero.
    """
    base = float(model.stages[-1].intercept)
    places = model.transform(df.select("neighborhood").distinct())
    baseline = F.col(INDEX) == F.lit(float(model.stages[-1].numFeatures))
    distance = F.when(baseline, 0.0).otherwise(F.col("prediction") - F.lit(base))
    return places.select(
        "neighborhood",
        INDEX,
        distance.alias("coefficient"),
        F.lit(base).alias("intercept"),
    )


def fit_quality(scored: DataFrame) -> DataFrame:
    """r2 and mean absolute error of predictions, in one pass."""
    actual, error = F.col(LABEL), F.col(LABEL) - F.col("prediction")
    unexplained = F.try_divide(F.sum(error * error), F.regr_syy(actual, F.col("prediction")))
    return scored.agg(
        (F.lit(1.0) - unexplained).alias("r2"),
        F.avg(F.abs(error)).alias("mean_absolute_error"),
    )


def price_range(df: DataFrame) -> DataFrame:
    return df.agg(F.min(LABEL).alias("lowest"), F.max(LABEL).alias("highest"))
