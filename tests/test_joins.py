import uuid

import pytest
from pyspark.sql import functions as F

from civica.checks import QUERIES
from civica.operators.joins import join_on_keys
from civica.sources.files import read_csv

MODES = ["inner", "left", "right", "full", "left_semi", "left_anti"]


@pytest.mark.parametrize("how", MODES)
def test_modes_agree_on_both_sides_of_the_bound(spark, rows, how):
    left = spark.createDataFrame([(1, n) for n in range(20)] + [(None, 99)], "k int, n int")
    right = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    below = join_on_keys(left, right, ["k"], how)
    above = join_on_keys(left, right, ["k"], how, max_rows=0)
    measured = join_on_keys(left, right, ["k"], how, max_rows=100)
    plain = left.join(right, ["k"], how)
    assert below.columns == plain.columns
    assert rows(below) == rows(above) == rows(measured) == rows(plain)


def jobs_of(spark, build):
    """How many jobs building a frame starts."""
    group = f"build-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    build()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found


@pytest.mark.parametrize("how", MODES)
def test_building_a_join_starts_no_job(spark, how):
    left, right = spark.range(100).withColumnRenamed("id", "k"), spark.range(7).selectExpr("id AS k", "id AS v")
    assert jobs_of(spark, lambda: join_on_keys(left, right, ["k"], how)) == 0
    assert jobs_of(spark, lambda: join_on_keys(left, right, ["k"], how, max_rows=5)) > 0


@pytest.mark.parametrize("how", MODES)
def test_hot_keys_on_both_sides_are_split(spark, how):
    """Beyond any broadcast; a third of either side holds one key."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.shuffle.partitions": "8"}
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        key = "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS k"
        left = spark.range(0, 3000, 1, 6).selectExpr(key, "sha(CAST(id AS STRING)) AS a")
        right = spark.range(2000, 4000, 1, 6).selectExpr(key, "sha(CAST(id AS STRING)) AS b")
        joined = join_on_keys(left, right, ["k"], how)
        got = joined.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*joined.columns)), F.sum("k"))
        plain = left.join(right, ["k"], how)
        want = plain.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*plain.columns)), F.sum("k"))
        assert got.collect() == want.collect()
        if how in ("inner", "left", "right", "full"):
            assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("key", ["kpi_price_district", "reconcile_listings"])
def test_building_a_query_starts_few_jobs(spark, key):
    """Only those that read the schemas of the test tables."""
    build = lambda: QUERIES[key](spark, "/root/testdata/sf0.001")
    build()
    assert jobs_of(spark, build) == 0


def test_a_header_that_disagrees_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,id\nz,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path), ",", "id string, name string").collect()
