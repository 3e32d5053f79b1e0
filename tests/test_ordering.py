"""Places and ranks against windows."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica.operators import aggregates, filters, profiling, ranking, shaping
from civica.operators.ordering import numbered


def frame(spark, n=600):
    r = random.Random(n)
    rows = [(r.choice(["hot", "hot", "a", None]), r.choice([1, 1, 1, 2, 5, None]), k) for k in range(n)]
    return spark.createDataFrame(rows, "g string, `v.x` int, part int").repartition(5)


def test_places_have_no_gaps(spark, rows):
    df = frame(spark)
    got = numbered(df, ["v.x", "part"], ["g"], "position")
    window = Window.partitionBy("g").orderBy("`v.x`", "part")
    assert got.columns == [*df.columns, "position"]
    want = df.withColumn("position", F.row_number().over(window).cast("bigint") - 1)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    copies = df.select("g").unionAll(df.select("g"))
    found = numbered(copies, ["g"], out="n")
    assert sorted(r.n for r in found.collect()) == list(range(1200))
    assert numbered(df.limit(0), ["part"]).count() == 0


def test_spread_ranks_are_ranks(spark, rows):
    df = frame(spark).withColumnRenamed("v.x", "v")
    for keys in (["g"], []):
        want = df.withColumn("rank", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("v"))).cast("bigint"))
        assert rows(ranking.rank_spread(df, keys, "v")) == rows(want)


def test_one_group_is_ranked_by_many_tasks(spark):
    df = spark.range(0, 20_000, 1, 8).selectExpr("1 AS g", "id % 3 AS v")
    ranked = ranking.rank_spread(df, ["g"], "v")
    assert {(r.v, r["rank"]) for r in ranked.distinct().collect()} == {(2, 1), (1, 6667), (0, 13334)}
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4k",
            "spark.sql.files.openCostInBytes": "4k"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        tasks = numbered(df, ["v"], ["g"]).where("v = 0").select(F.spark_partition_id()).distinct().count()
        assert tasks > 1  # even the rows of one value
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_lists_of_bounded_parts(spark, rows):
    df = frame(spark)
    got = aggregates.collect_chunks(df, ["g"], "v.x", "values", size=7)
    want = {}
    for r in df.where("`v.x` is not null").collect():
        want.setdefault(r["g"], []).append(r["v.x"])
    assert rows(got) == sorted(
        ((g, n // 7, sorted(found)[n:n + 7]) for g, found in want.items() for n in range(0, len(found), 7)), key=repr)
    whole = aggregates.collect_chunks(df, [], "part", "chunk_values", size=1000)
    assert rows(whole) == [(0, list(range(600)))]
    assert aggregates.collect_chunks(df.limit(0), ["g"], "v.x", "values").collect() == []


def test_names_with_dots(spark, rows):
    df = spark.createDataFrame([(1, "2", (3,)), (None, "x", (4,))], "`a.b` int, `c.d` string, `e.f` struct<x: int>")
    assert rows(shaping.project(df, ["a.b"])) == [(1,), (None,)]
    assert rows(shaping.recast_numbers(df, ["c.d"]).select("`c.d`")) == [(2.0,), (None,)]
    assert shaping.flatten_struct(df, "e.f").columns == ["a.b", "c.d", "x"]
    assert rows(filters.keep_equal(df, "c.d", "x").select("`c.d`")) == [("x",)]
    assert filters.keep_not_null(df, "a.b").count() == 1
    assert shaping.align_types(df, T.StructType([T.StructField("c.d", T.IntegerType())])).schema["c.d"].dataType == T.IntegerType()


def test_cleaning_of_a_stored_input(spark, rows):
    df = spark.range(200).selectExpr("id * 1.5D AS v", "1.0D AS flat", "cast(id % 50 as string) AS t", "'x' AS top")
    assert rows(profiling.clean_full(df, store=True)) == rows(profiling.clean_full(df))
    assert profiling.clean_full(df, store=True).columns == ["v", "t"]
