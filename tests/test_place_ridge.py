"""The closed form against pyspark.ml, and against its own normal equations."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from civica.plans import place_ridge, price_model


def priced(spark, labels, rows, seed=1):
    r = random.Random(seed)
    level = [r.uniform(100, 900) for _ in range(labels)]
    data = [(f"n{k % labels if k < labels else int(labels * r.random() ** 2)}", k) for k in range(rows)]
    data = [(name, level[int(name[1:])] + r.gauss(0, 50)) for name, _ in data]
    return data, spark.createDataFrame(data + [(None, 5.0), ("n0", None)], "neighborhood string, price double")


@pytest.mark.parametrize("labels", [2, 10, 60])
def test_as_the_pipeline(spark, labels):
    _, df = priced(spark, labels, 800)
    pipeline = price_model.fit_price_model(df)
    want = {r.neighborhood: r for r in price_model.coefficients(pipeline, df.dropna()).collect()}
    got = {r.neighborhood: r for r in place_ridge.fit_place_ridge(df).collect()}
    assert got.keys() == want.keys()
    for name, row in got.items():
        assert row.neighborhood_index == want[name].neighborhood_index
        assert row.coefficient == pytest.approx(want[name].coefficient, abs=1e-6)
        assert row.intercept == pytest.approx(want[name].intercept, rel=1e-9)
    scored = place_ridge.score_place_ridge(place_ridge.fit_place_ridge(df), df, "neighborhood")
    plain = price_model.score(pipeline, df, "neighborhood")
    total = lambda x: x.agg(F.count(F.lit(1)), F.sum("prediction")).first()
    assert total(scored)[0] == total(plain)[0]
    assert total(scored)[1] == pytest.approx(total(plain)[1], rel=1e-9)


@pytest.mark.parametrize("labels", [10, 10_000])
def test_normal_equations_hold(spark, labels):
    """The gradient is zero in every coefficient and in the intercept."""
    data, df = priced(spark, labels, 3 * labels + 500)
    model = {r.neighborhood: r for r in place_ridge.fit_place_ridge(df).collect()}
    y = np.array([price for _, price in data])
    rest = y - np.array([model[name].intercept + model[name].coefficient for name, _ in data])
    assert abs(rest.mean()) < 1e-8
    sums, counts = {}, {}
    for (name, _), x in zip(data, rest):
        sums[name], counts[name] = sums.get(name, 0.0) + x, counts.get(name, 0) + 1
    assert len(model) == len(counts)
    last = max(model.values(), key=lambda row: row.neighborhood_index).neighborhood
    for name, row in model.items():
        share = counts[name] / len(y)
        slope = sums[name] / len(y) - 0.1 / y.std() * share * (1 - share) * row.coefficient
        assert (row.coefficient == 0) if name == last else abs(slope) < 1e-9


def test_odd_rows(spark):
    schema = "neighborhood string, price double"
    assert place_ridge.fit_place_ridge(spark.createDataFrame([], schema)).count() == 0
    one = place_ridge.fit_place_ridge(spark.createDataFrame([("a", 1.0), ("a", 3.0)], schema)).collect()
    assert [(r.coefficient, r.intercept) for r in one] == [(0.0, 2.0)]
    flat = place_ridge.fit_place_ridge(spark.createDataFrame([("a", 2.0), ("b", 2.0), ("b", 2.0)], schema)).collect()
    assert {(r.neighborhood, r.coefficient, r.intercept) for r in flat} == {("a", 0.0, 2.0), ("b", 0.0, 2.0)}
