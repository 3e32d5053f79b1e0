import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica.operators import aggregates, filters, joins, moments, profiling, ranking, shaping


def test_flatten_overwrites_and_passes_through(spark, rows):
    df = spark.sql("SELECT 1 AS id, 'old' AS name, struct('new' AS name, 2 AS extra) AS s")
    flat = shaping.flatten_struct(df, "s")
    assert sorted(flat.columns) == ["extra", "id", "name"]
    assert rows(flat, "id", "name", "extra") == [(1, "new", 2)]
    assert shaping.flatten_struct(df, "absent") is df


def test_flatten_field_named_like_its_struct(spark, rows):
    df = spark.sql("SELECT struct(7 AS s, 8 AS t) AS s")
    assert rows(shaping.flatten_struct(df, "s"), "s", "t") == [(7, 8)]


def test_first_record_of_empty_and_missing_arrays(spark, rows):
    df = spark.createDataFrame(
        [(1, [(5.0, 3)]), (2, []), (3, None)], "id int, info array<struct<RFD: double, pop: int>>")
    got = shaping.first_record(df, "info", ["RFD", "pop"])
    assert rows(got, "id", "RFD", "pop") == [(1, 5.0, 3), (2, None, None), (3, None, None)]


def test_union_matches_names_not_positions(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([("y", 2, True)], "name string, id int, flag boolean")
    assert rows(shaping.union_frames([a, b]), "id", "name", "flag") == [
        (1, "x", None), (2, "y", True)]
    assert shaping.align_union([b, a]).columns == ["flag", "id", "name"]


def test_align_types(spark, rows):
    df = spark.createDataFrame([("1", "x"), ("no", "y")], "n string, other string")
    target = T.StructType().add("n", "integer").add("absent", "double")
    got = shaping.align_types(df, target)
    assert got.schema["n"].dataType == T.IntegerType()
    assert rows(got) == [(1, "x"), (None, "y")]


def test_drop_and_recast_ignore_absent_columns(spark, rows):
    df = spark.createDataFrame([("1.5", "a")], "n string, x string")
    assert shaping.drop_columns(df, ["x", "absent"]).columns == ["n"]
    assert rows(shaping.recast_numbers(df, ["n", "absent"]), "n") == [(1.5,)]


def test_not_in_drops_null(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    assert rows(filters.keep_not_in(df, "p", ["a"])) == [("b",)]
    assert rows(filters.keep_equal(df, "p", "a")) == [("a",)]
    assert rows(filters.keep_not_null(df, "p")) == [("a",), ("b",)]


@pytest.fixture
def skewed(spark):
    """One key with most of the rows, some NULL keys, copies of rows, and misses."""
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, "hot")
        .when(F.col("id") % 30 == 0, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 100).alias("v"))
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k3", 3), ("k9", 4), (None, 5), ("unused", 6)],
        "k string, w int")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("spread_by", [(), ("v",)])
def test_spread_join_equals_plain_join(skewed, rows, how, spread_by):
    left, right = skewed
    plain = left.join(right, ["k"], how)
    assert rows(joins.spread_join(left, right, ["k"], how, spread_by)) == rows(plain)


def test_spread_join_of_keys_of_different_types(spark, rows):
    left = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    right = spark.createDataFrame([(0, "zero"), (1, "one")], "k int, name string")
    assert rows(joins.spread_join(left, right, ["k"])) == rows(left.join(right, ["k"]))


def test_hot_keys_are_found_and_few(skewed):
    left, _ = skewed
    hot = joins._hot_hashes(left, ["k"], 0.02)
    assert left.select(F.xxhash64(F.lit("hot"))).first()[0] in hot
    assert left.select(F.xxhash64(F.lit(None).cast("string"))).first()[0] in hot
    assert len(hot) <= 50


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_bound(skewed, rows):
    left, right = skewed
    small = joins.join_on_keys(left, right, ["k"])
    assert "BroadcastHashJoin" in plan(small)
    large = joins.join_on_keys(left, right, ["k"], max_rows=2)
    assert not joins.fits_broadcast(right, max_rows=2)
    assert not joins.fits_broadcast(right, max_bytes=120)
    assert rows(small) == rows(large)


def test_shared_columns_come_out_once(spark, rows):
    a = spark.createDataFrame([(1, "left")], "k int, name string")
    b = spark.createDataFrame([(1, "right", 9)], "k int, name string, extra int")
    assert rows(joins.join_on_keys(a, b, ["k"]), "k", "name", "extra") == [(1, "left", 9)]


def test_lookup_keeps_misses_and_replaces_column(spark, rows):
    df = spark.createDataFrame([(1, "gracia"), (2, "sants"), (3, None)], "id int, district string")
    lookup = spark.createDataFrame([("gracia", "Gràcia")], "di string, di_re string")
    got = joins.attach_lookup(df, lookup, "district", "di", "di_re", "district")
    assert rows(got, "id", "district") == [(1, "Gràcia"), (2, None), (3, None)]


def test_ranks_keep_ties(spark, rows):
    df = spark.createDataFrame(
        [("d", "a", 5.0), ("d", "b", 5.0), ("d", "c", 4.0), ("e", "a", None)],
        "district string, party string, votes double")
    top = ranking.top_within(df, ["district"], "votes")
    assert rows(top, "party", "rank") == [("a", 1), ("a", 1), ("b", 1)]
    assert rows(ranking.rank_within(df, ["district"], "votes"), "district", "rank") == [
        ("d", 1), ("d", 1), ("d", 3), ("e", 1)]


def test_sorted_result_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 2.0)], "k string, v double")
    assert [r["k"] for r in ranking.order_descending(df, "v", ["k"]).collect()] == ["c", "a", "b"]


def test_frequency_counts_null(spark):
    df = spark.createDataFrame([("x",), (None,), ("x",)], "c string")
    got = [tuple(r) for r in aggregates.frequency(df, "c").collect()]
    assert got == [(None, 1), ("x", 2)]


def test_collect_repeats_equal_values(spark, rows):
    df = spark.createDataFrame(
        [("a", "p", 1.0), ("a", "p", 2.0), ("a", "b", 3.0), ("n", None, 4.0)],
        "k string, shape string, w double")
    got = aggregates.collect_by(df, ["k"], "shape", "shapes", sums=["w"])
    assert rows(got, "k", "w", "shapes") == [("a", 6.0, ["b", "p", "p"]), ("n", 4.0, [])]


def test_matrix_equals_pandas_with_missing_values(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(rng.normal(1e6, 3, (200, 4)), columns=list("abcd"))
    frame["b"] += frame["a"]
    for i, column in enumerate("abc"):
        frame.loc[rng.random(200) < 0.2 * (i + 1), column] = None
    frame["d"] = 7.5
    data = [tuple(None if pd.isna(v) else float(v) for v in row) for row in frame.to_numpy()]
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(3)
    want = frame.corr()
    got = moments.corr_matrix(df, list("abcd")).collect()
    assert len(got) == 6
    for row in got:
        expected = want.loc[row["x"], row["y"]]
        if math.isnan(expected):
            assert row["r"] is None
        else:
            assert math.isclose(row["r"], expected, rel_tol=1e-9, abs_tol=1e-9)


def profile_frame(spark):
    return spark.range(1000).select(
        "id",
        F.when(F.col("id") % 20 == 0, 1.0).alias("sparse"),
        F.lit(3.0).cast("decimal(5,2)").alias("const"),
        F.when(F.col("id") % 50 == 0, "z").otherwise("a").alias("dominant"),
        F.concat(F.lit("u"), "id").alias("unique"),
        F.when(F.col("id") % 25 > 0, "y").alias("mostly"))


def test_profile_steps(spark):
    df = profile_frame(spark)
    assert {r["column"]: r["nulls"] for r in profiling.null_profile(df).collect()} == {
        "id": 0, "sparse": 950, "const": 0, "dominant": 0, "unique": 0, "mostly": 40}
    assert "sparse" not in profiling.drop_sparse_columns(df).columns
    assert "const" not in profiling.drop_low_variance(df).columns
    assert set(df.columns) - set(profiling.drop_dominant(df).columns) == {"dominant", "mostly"}
    assert profiling.clean_full(df).columns == ["id", "unique"]


def test_dominance_looks_at_counts_not_at_the_last_value(spark):
    df = spark.range(100).select(F.when(F.col("id") == 0, "zz").otherwise("aa").alias("c"))
    assert profiling.drop_dominant(df).columns == []


def test_low_dominance_limit_counts_every_value(spark):
    df = spark.range(100).select((F.col("id") % 4).cast("string").alias("c"))
    assert profiling.drop_dominant(df, 0.3).columns == ["c"]
    assert profiling.drop_dominant(df, 0.2).columns == []


def test_empty_frames_are_left_alone(spark):
    df = spark.createDataFrame([], "a string, b double")
    for step in (profiling.drop_sparse_columns, profiling.drop_low_variance,
                 profiling.drop_dominant, profiling.clean_full):
        assert step(df).columns == ["a", "b"]


def test_single_row_deviation_is_unknown(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert profiling.drop_low_variance(df).columns == ["a", "b"]


def test_dominant_values_at_any_limit(spark):
    """Against plain counts, for limits on both sides of a half; no value is shuffled."""
    df = spark.range(2000).select(
        F.when(F.col("id") % 10 < 3, "x").otherwise(F.col("id").cast("string")).alias("third"),
        F.when(F.col("id") % 10 < 6, None).otherwise(F.col("id").cast("string")).alias("nulls"),
        (F.col("id") % 50).cast("string").alias("even"), F.col("id").cast("string").alias("unique"))
    for limit in (0.01, 0.019, 0.021, 0.25, 0.299, 0.301, 0.55, 0.61):
        want = [c for c in df.columns if df.groupBy(c).count().agg(F.max("count")).first()[0] / 2000 <= limit]
        assert profiling.drop_dominant(df, limit).columns == want, limit
    with pytest.raises(ValueError):
        profiling.drop_dominant(df, 0.0)
