import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from civica import session
from civica.checks import files as file_checks
from civica.plans import batch
from civica.sources import collections, exports, files, models


def test_folder_of_mixed_files(spark, rows, tmp_path, caplog):
    (tmp_path / "a.csv").write_text('id;name\n1;"""La X, Y"""\n2;plain\n')
    (tmp_path / "b.json").write_text('{"id": 3, "name": "z"}\n')
    (tmp_path / ".hidden.csv").write_text("id;name\n9;no\n")
    (tmp_path / "notes.txt").write_text("not data")
    spark.range(2).write.parquet(str(tmp_path / "c.parquet"))
    frames = files.load_files(spark, str(tmp_path))
    assert sorted(frames) == ["a.csv", "b.json", "c.parquet"]
    assert rows(frames["a.csv"]) == [("1", '"La X, Y"'), ("2", "plain")]
    assert rows(frames["c.parquet"]) == [(0,), (1,)]
    assert "notes.txt" in caplog.text


@pytest.mark.parametrize(
    "path, folder, found",
    [
        ("file:/data/raw/a.csv", "/data/raw", "a.csv"),
        ("file:/data/raw/x/a.csv", "file:///data/raw/", "x"),
        ("hdfs://data/data/raw.d/a.csv", "hdfs:///data/raw.d", "a.csv"),
        ("s3a://bucket/a/b/c", "s3a://bucket/a", "b"),
        ("file:/home/me/raw/a.csv", "raw", "a.csv"),
    ],
)
def test_path_below(spark, path, folder, found):
    df = spark.createDataFrame([(path,)], "path string")
    assert df.select(files.path_below(df["path"], folder)).first()[0] == found


def test_schemas_by_name_and_extension(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text('{"id": 3}\n')
    schemas = {"json": "id int", "b.json": "id string"}
    frames = files.load_files(spark, str(tmp_path), schemas=schemas)
    assert frames["a.json"].schema["id"].dataType == T.IntegerType()
    assert frames["b.json"].schema["id"].dataType == T.StringType()


def test_json_array_file(spark, rows, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1},\n {"id": 2}]')
    frames = files.load_files(spark, str(tmp_path), multi_line=True)
    assert rows(frames["a.json"]) == [(1,), (2,)]


def test_snapshots_read_every_file_and_merge_columns(spark, rows, tmp_path):
    for folder, frame in {
        "2020 01+x": spark.sql("SELECT 1 AS id, 'a' AS only_first"),
        "2020_02": spark.sql("SELECT 2 AS id, true AS only_second"),
    }.items():
        frame.write.parquet(str(tmp_path / folder))
    spark.sql("SELECT 3 AS id").write.mode("append").parquet(str(tmp_path / "2020_02"))
    got = files.load_snapshots(spark, str(tmp_path))
    assert rows(got, "snapshot", "id", "only_first", "only_second") == [
        ("2020 01+x", 1, "a", None), ("2020_02", 2, None, True), ("2020_02", 3, None, None)]


def test_collections_append_replace_and_errors(spark, rows, tmp_path):
    store, df = str(tmp_path), spark.range(2)
    collections.write_collection(df, "c", store)
    collections.write_collection(df, "c", store)
    assert collections.read_collections(spark, ["c"], store)["c"].count() == 4
    collections.write_collection(df, "c", store, append=False)
    assert rows(collections.read_collections(spark, ["c"], store)["c"]) == [(0,), (1,)]
    with pytest.raises(AnalysisException):
        collections.read_collections(spark, ["missing"], store)


def test_catalogue_tables(spark, rows):
    schema = T.StructType().add("id", "long")
    collections.create_collection(spark, "places", schema)
    collections.write_collection(spark.range(3), "places")
    collections.create_collection(spark, "places", schema)
    assert collections.read_collections(spark, ["places"])["places"].count() == 3
    collections.write_collection(spark.range(1), "places", append=False)
    assert rows(collections.read_collections(spark, ["places"])["places"]) == [(0,)]
    collections.drop_collection(spark, "places")
    collections.drop_collection(spark, "places")
    assert not spark.catalog.tableExists("places")


def test_export_is_one_ordered_file(spark, tmp_path):
    df = spark.createDataFrame([("b", 2.0), ('"a, b"', 1.0), (None, 3.0)], "k string, v double")
    exports.export_csv(df.repartition(3), str(tmp_path / "out"), order=["v"])
    parts = list((tmp_path / "out").glob("*.csv"))
    assert len(parts) == 1
    assert parts[0].read_text().splitlines()[0] == "k,v"
    back = files.read_csv(spark, str(tmp_path / "out"), ",", "k string, v double")
    assert [tuple(r) for r in back.collect()] == [('"a, b"', 1.0), ("b", 2.0), (None, 3.0)]


def test_export_beyond_one_file_is_ordered_parts(spark, rows, tmp_path):
    # Two thirds of the rows are equal in the order, and a name holds a dot.
    df = spark.range(3000).selectExpr("if(id % 3 = 0, -id, 7) `a.b`", "concat('x,', id % 5) name").repartition(4)
    out, schema = str(tmp_path / "out"), "`a.b` long, name string"
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        exports.export_csv(df, out, order=["`a.b`"], single_bytes=1000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    parts = sorted((tmp_path / "out").glob("*.csv"))
    lines = [part.read_text().splitlines() for part in parts]
    assert len(parts) == 4 and max(map(len, lines)) < 1500
    assert {x[0] for x in lines} == {"a.b,name"}
    values = [int(line.split(",")[0]) for x in lines for line in x[1:]]
    assert values == sorted(values)
    assert rows(files.read_csv(spark, out, ",", schema)) == rows(df)
    # Within the bound the same rows are one file.
    exports.export_csv(df, out, order=["`a.b`"])
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1
    assert rows(files.read_csv(spark, out, ",", schema)) == rows(df)


def test_export_of_nothing_is_a_header(spark, tmp_path):
    for bound in (0, 1000):
        exports.export_csv(spark.range(0), str(tmp_path / "none"), order=["id"], single_bytes=bound)
        assert [p.read_text() for p in (tmp_path / "none").glob("*.csv")] == ["id\n"]


def test_head_is_ordered(spark, rows, tmp_path):
    exports.export_head(spark.range(50).repartition(5), str(tmp_path / "h"), ["id"], rows=3)
    assert rows(files.read_csv(spark, str(tmp_path / "h"), ",", "id int")) == [(0,), (1,), (2,)]


def test_csv_to_json_per_file(spark, rows, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "y2015.csv").write_text("id,name\n1,a\n")
    (source / "y2019.csv").write_text("id,name\n2,\n")
    exports.csv_to_json(spark, str(source), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("file=*")) == ["file=y2015", "file=y2019"]
    back = spark.read.json(str(tmp_path / "out"))
    assert rows(back, "file", "id", "name") == [("y2015", "1", "a"), ("y2019", "2", None)]
    assert (source / "y2015.csv").read_text() == "id,name\n1,a\n"


def test_batch_stores_model_and_results(spark, tmp_path):
    zone = file_checks._raw_zone(spark, "/root/testdata/sf0.001")
    formatted, results = str(tmp_path / "formatted"), str(tmp_path / "results")
    batch.run_batch(spark, zone, formatted, results)
    batch.run_batch(spark, zone, formatted, results)
    names = ["kpi1", "kpi2", "kpi3", "predictive_model"]
    stored = collections.read_collections(spark, names, results)
    assert stored["kpi1"].columns == ["district", "avg_price", "participation"]
    assert stored["predictive_model"].where("file LIKE 'metadata/%'").count() >= 1
    assert models.load_model(f"{results}/linear_regression").stages[-1].numFeatures > 0


class FakeConf:
    def __init__(self, folder):
        self.folder = folder

    def get(self, key, default):
        return self.folder or default


class FakeSpark:
    def __init__(self, folder, master):
        self.conf = FakeConf(folder)
        self.sparkContext = type("Context", (), {"master": master})()


def test_shared_folder_is_never_local_on_a_cluster():
    named = session.scratch_path(FakeSpark("hdfs://nn/shared/", "yarn"), "x")
    assert named.startswith("hdfs://nn/shared/x-")
    with pytest.raises(ValueError):
        session.shared_folder(FakeSpark(None, "yarn"))


def jobs_while(spark, work):
    group = f"work-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, group)
    work()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found


def test_csv_to_json_follows_each_header(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("id,name\n1,a\n")
    (source / "b.csv").write_text("name,id\nb,2\n")
    (source / "c+d 1.csv").write_text('\n"id",extra,name\n3,"x, y",c\n')
    (source / "empty.csv").write_text("")
    (source / "head.csv").write_text("id,name\n")
    exports.csv_to_json(spark, str(source), str(tmp_path / "out"))
    text = {p.parent.name: p.read_text().strip() for p in (tmp_path / "out").glob("file=*/*.json")}
    assert text["file=a"] == '{"id":"1","name":"a"}'
    assert text["file=b"] == '{"name":"b","id":"2"}'
    assert [v for k, v in text.items() if "c+d" in k or "c%2Bd" in k] == ['{"id":"3","extra":"x, y","name":"c"}']
    (source / "clash.csv").write_text("id,File\n1,x\n")
    with pytest.raises(ValueError):
        exports.csv_to_json(spark, str(source), str(tmp_path / "out"))


def test_jobs_follow_headers_not_files(spark, tmp_path):
    counts = []
    for n in (5, 60):
        folder = tmp_path / f"n{n}"
        folder.mkdir()
        for k in range(n):
            (folder / f"f{k:03}.csv").write_text(f"id;name\n{k};x\n")
        counts.append((
            jobs_while(spark, lambda: files.load_files(spark, str(folder))),
            jobs_while(spark, lambda: exports.csv_to_json(spark, str(folder), str(tmp_path / f"out{n}"), ";"))))
    assert counts[0] == counts[1]
    frames = files.load_files(spark, str(tmp_path / "n5"))
    assert [tuple(r) for r in frames["f003.csv"].collect()] == [("3", "x")]


def test_collections_below_a_store(spark, rows, tmp_path):
    store, schema = str(tmp_path / "store"), "id bigint, name string"
    for _ in range(2):
        collections.create_collection(spark, "c", schema, store)
        empty = collections.read_collections(spark, ["c"], store)["c"]
        assert empty.schema.simpleString() == "struct<id:bigint,name:string>" and empty.count() == 0
    collections.write_collection(spark.range(2).selectExpr("id", "'x' AS name"), "c", store)
    collections.create_collection(spark, "c", schema, store)
    assert collections.read_collections(spark, ["c"], store)["c"].count() == 2
    for _ in range(2):
        collections.drop_collection(spark, "c", store)
    with pytest.raises(AnalysisException):
        collections.read_collections(spark, ["c"], store)
    with pytest.raises(ValueError):
        collections.create_collection(spark, "c", schema, store, fmt="csv")
    with pytest.raises(ValueError):
        collections.drop_collection(spark, "", store)


def test_files_come_back_from_rows(spark, tmp_path):
    data = [("metadata/part-0", b"\x00\xff text"), ("stages/0_a b/data/x.parquet", b""), ("top", bytes(range(256)) * 900)]
    stored = spark.createDataFrame(data, "file string, content binary").repartition(3)
    target = tmp_path / "again"
    assert models.restore_model(stored, str(target)) == 3
    assert {str(p.relative_to(target)): p.read_bytes() for p in target.rglob("*") if p.is_file()} == dict(data)
    with pytest.raises(ValueError):
        models.restore_model(stored, str(target))
    for name in ("../out", "/etc/x", None):
        bad = spark.createDataFrame([(name, b"x")], "file string, content binary")
        with pytest.raises(Exception, match="no file of a model"):
            models.restore_model(bad, str(tmp_path / f"bad{name is None}{len(name or '')}"))
    assert not (tmp_path / "out").exists()
