"""Inputs that drift: names, types and schemas that differ from file to file."""

import logging

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException

from civica.operators import joins, shaping
from civica.plans import price_model, sheets
from civica.sources import files


def test_union_of_text_and_number_is_text(spark, rows):
    a = spark.createDataFrame([("abc",)], "price string")
    b = spark.createDataFrame([(2.5,)], "Price double")
    assert rows(shaping.union_frames([a, b])) == [("2.5",), ("abc",)]
    c = spark.createDataFrame([(1,)], "price int")
    assert rows(shaping.union_frames([b, c])) == [(1.0,), (2.5,)]


def test_names_that_differ_in_case_are_one_column(spark, rows):
    a = spark.createDataFrame([(1, 2.0)], "id int, Price double")
    b = spark.createDataFrame([(3.0, 2)], "price double, id int")
    got = shaping.align_union([a, b])
    assert got.columns == ["Price", "id"]
    assert rows(got) == [(2.0, 1), (3.0, 2)]


def test_snapshots_with_other_types(spark, rows, tmp_path):
    frames = {
        "2020_01": spark.createDataFrame([(1, 5)], "id int, price int"),
        "2020_02": spark.createDataFrame([(2, 7.5)], "id int, price double"),
        "2020_03": spark.createDataFrame([(3, "x")], "id int, price string"),
    }
    for name, frame in frames.items():
        frame.write.parquet(str(tmp_path / name))
    got = files.load_snapshots(spark, str(tmp_path))
    assert rows(got, "snapshot", "id", "price") == [
        ("2020_01", 1, "5"), ("2020_02", 2, "7.5"), ("2020_03", 3, "x")]


def test_snapshots_start_jobs_by_schema(spark, rows, tmp_path):
    kinds = [("int", "5", "price"), ("double", "7.5", "Price"), ("string", "'x'", "price")]

    def jobs(folder, snapshots):
        for n in range(snapshots):
            kind, value, name = kinds[n % 3]
            rest = ", 1 AS more" if n % 2 else ""
            table = spark.sql(f"SELECT {n} AS id, CAST({value} AS {kind}) AS {name}{rest}").toArrow()
            (tmp_path / folder / f"s {n}+[a]").mkdir(parents=True)
            pq.write_table(table, tmp_path / folder / f"s {n}+[a]" / "part.parquet")
        spark.sparkContext.setJobGroup(folder, folder)
        try:
            frame = files.load_snapshots(spark, str(tmp_path / folder))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return frame, len(spark.sparkContext.statusTracker().getJobIdsForGroup(folder))

    few, started = jobs("few", 6)
    _, middle = jobs("middle", 105)
    many, also = jobs("many", 200)
    # Spark lists more than 32 paths of a reader in a job.
    assert started <= middle == also <= started + 4
    assert many.count() == 200 and [c.lower() for c in many.columns] == ["id", "price", "more", "snapshot"]
    assert rows(few, "snapshot", "id", "price", "more")[:3] == [
        ("s 0+[a]", 0, "5", None), ("s 1+[a]", 1, "7.5", 1), ("s 2+[a]", 2, "x", None)]


def test_snapshot_of_mixed_files_and_nested_columns(spark, rows, tmp_path):
    a = spark.sql("SELECT 1 AS id, named_struct('x', 1, 'y', 'b') AS s, 1L AS n")
    b = spark.sql("SELECT 2 AS id, named_struct('x', 2, 'z', 2.5D) AS s, 2L AS n")
    c = spark.sql("SELECT 3 AS id, named_struct('x', 3) AS s, 3.5D AS n")
    for frame in (a, b, c):
        frame.write.mode("append").parquet(str(tmp_path / "2020"))
    got = files.load_snapshots(spark, str(tmp_path))
    assert rows(got, "snapshot", "id", "s.x", "s.y", "s.z", "n") == [
        ("2020", 1, 1, "b", None, 1.0), ("2020", 2, 2, None, 2.5, 2.0), ("2020", 3, 3, None, None, 3.5)]


def test_views_are_cleaned_and_collisions_refused(spark, rows):
    df = spark.createDataFrame([(1,)], "id int")
    assert files.register({"2015-x.csv": df, "b.json": df}) == ["_2015_x", "b"]
    assert rows(spark.table("_2015_x")) == [(1,)]
    with pytest.raises(ValueError):
        files.register({"a.csv": df, "A.json": df})


def test_names_spark_passes_over_are_reported(spark, tmp_path, caplog):
    for name in ("_a.csv", "b.csv", ".c.csv"):
        (tmp_path / name).write_text("id\n1\n")
    with caplog.at_level(logging.WARNING):
        assert list(files.load_files(spark, str(tmp_path))) == ["b.csv"]
    assert "_a.csv" in caplog.text and ".c.csv" not in caplog.text


def test_hot_keys_of_different_width(spark, rows):
    left = spark.createDataFrame([(7, i) for i in range(20)] + [(8, 20)], "k int, v int")
    right = spark.createDataFrame([(7, "x"), (9, "y")], "k bigint, name string")
    for how in ("inner", "left", "right", "full", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        got = joins.join_on_keys(left, right, ["k"], how, max_rows=0)
        assert rows(got, *plain.columns) == rows(plain), how


def test_split_needs_a_key_and_reads_one_part(spark, rows, tmp_path):
    df = spark.createDataFrame([(str(i), "a", 1.0) for i in range(50)], "k string, neighborhood string, price double")
    train, test = price_model.stored_split(df, "k", str(tmp_path / "rows"))
    assert train.count() + test.count() == 50
    plan = train._jdf.queryExecution().executedPlan().toString()
    assert "part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    with pytest.raises(PySparkException, match="without k"):
        price_model.with_split(spark.createDataFrame([(None,)], "k string"), "k").collect()


def test_correlations_of_the_joined_districts(spark, rows):
    metrics = spark.createDataFrame(
        [("A", "9,5", "0,1"), ("B", "10,5", "0,2"), ("C", "1,5", "0,3")],
        "district string, avg_price string, participation string")
    shapes = spark.createDataFrame([("A", "p"), ("A", "q"), ("B", "r")], "nom_districte string, geometria_wgs84 string")
    parties = spark.createDataFrame(
        [(d, "P", "1") for d in "ABC"], "district string, Party string, total_votes string")
    correlations = spark.createDataFrame(
        [("A", "0,5"), ("A", "-0,25"), ("C", "0,1")], "district string, correlation string")
    dashboard = sheets.dashboard_join(metrics, shapes, parties)
    related = sheets.dashboard_relate(dashboard, correlations)
    assert rows(related, "district", "avg_price", "participation", "correlation") == [
        ("A", "9,5", "0,1", "-0,25"), ("A", "9,5", "0,1", "0,5"), ("B", "10,5", "0,2", None)]
    assert rows(sheets.sheet_correlation(related), "district", "correlation") == [
        ("A", -0.25), ("A", 0.5), ("B", None)]
