import math

import pytest
from pyspark.sql import functions as F

from civica.functions.names import normalize_name
from civica.functions.numbers import (
    decimal_comma_text,
    map_values,
    parse_decimal_comma,
    ratio,
    step_class,
    to_double,
)
from civica.functions.statistics import safe_corr


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "raw, loose, tight",
    [
        ("La Barceloneta", "la barceloneta", "la barceloneta"),
        ("Sant Martí-Provençals", "sant mart  proven als", "sant martprovenals"),
        ("L'Hospitalet_2", "l hospitalet2", "lhospitalet_2"),
        (None, None, None),
    ],
)
def test_normalize_name(spark, raw, loose, tight):
    assert one(spark, raw, normalize_name) == loose
    assert one(spark, raw, lambda c: normalize_name(c, tight=True)) == tight
    assert one(spark, raw, lambda c: normalize_name(normalize_name(c))) == loose


@pytest.mark.parametrize(
    "text, value",
    [("1234,5", 1234.5), ("12.5", 12.5), ("1.234,5", None), ("abc", None), (None, None)],
)
def test_parse_decimal_comma(spark, text, value):
    assert one(spark, text, parse_decimal_comma) == value


def test_decimal_comma_text_is_never_scientific(spark):
    assert one(spark, 123456789.5, decimal_comma_text, "double") == "123456789,5000"


def test_bad_numbers_are_null(spark):
    assert one(spark, "abc", to_double) is None
    assert one(spark, 1.0, lambda c: ratio(c, F.lit(0)), "double") is None


@pytest.mark.parametrize(
    "value, step",
    [(-1.0, 1), (-0.8, 1), (0.0, 4), (0.99, 7), (1.0, 7), (1.5, 7), (-3.0, 1), (None, None)],
)
def test_step_class(spark, value, step):
    assert one(spark, value, step_class, "double") == step


def test_map_values_leaves_unknown_null(spark):
    colours = {"PP": "blue"}
    assert one(spark, "PP", lambda c: map_values(c, colours)) == "blue"
    assert one(spark, "ERC", lambda c: map_values(c, colours)) is None


def test_safe_corr(spark):
    df = spark.createDataFrame(
        [
            ("line", 1.0, 2.0), ("line", 2.0, 4.0), ("line", 3.0, 6.0), ("line", None, 9.0),
            ("constant", 1.0, 5.0), ("constant", 2.0, 5.0),
            ("single", 1.0, 1.0),
            ("empty", None, 1.0),
        ],
        "k string, x double, y double",
    )
    found = {r["k"]: r["r"] for r in df.groupBy("k").agg(safe_corr("x", "y").alias("r")).collect()}
    assert math.isclose(found.pop("line"), 1.0)
    assert found == {"constant": None, "single": None, "empty": None}
