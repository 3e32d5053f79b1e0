"""Reading the raw zone: folders of JSON, CSV and Parquet files."""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civica.operators.shaping import union_frames

log = logging.getLogger(__name__)

Schema = T.StructType | str
Schemas = Mapping[str, Schema]


def path_below(path: Column, folder: str, part: str = "[^/]+") -> Column:
    """What ``path`` has below ``folder``: its next component, or all of it (``.+``).

    Spark lists files by their full path, so scheme and host are left out of the match.
    """
    place = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", folder).rstrip("/")
    lead = "" if place.startswith("/") else ".*?/"
    pattern = rf"^(?:[^:/]+:)?(?://[^/]*)?{lead}\Q{place}\E/+({part})"
    return F.regexp_extract(path, pattern, 1)


def list_entries(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``, without those that start with a dot.

    The file system that Spark uses for the path does the listing, in one call.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = (entry.getPath().getName() for entry in listed)
    return sorted(name for name in names if not name.startswith("."))


def read_csv(
    spark: SparkSession, path: str | list[str], delimiter: str = ";", schema: Schema | None = None
) -> DataFrame:
    """CSV with a header. Quotes inside a quoted value are doubled, so names that hold
    quotes and commas stay in one column. Without a schema all columns are text. A header
    that disagrees with the schema, or with that of the first file, raises."""
    reader = spark.read.option("enforceSchema", False).option("header", True).option("sep", delimiter).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def first_lines(spark: SparkSession, folder: str, names: Sequence[str], glob: str = "*") -> dict[str, str]:
    """The first line that isn't blank of each named CSV file or folder of files below
    ``folder``, in one job; entries without any have none. Of a folder it is that of its first file.
    Files whose names don't fit ``glob`` are not read.

    Each task keeps the first line of the files whose beginning it reads, and only those
    lines are gathered. A header whose quoted names hold a line end isn't supported.
    """
    if not names:
        return {}
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(folder)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    lines = lines.where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != "")).select(
        path.alias("path"), F.monotonically_increasing_id().alias("at"), "value")
    by_file = lines.groupBy("path").agg(F.min_by("value", "at").alias("value"))
    found = by_file.groupBy(path_below(F.col("path"), folder).alias("name")).agg(F.min_by("value", "path").alias("value"))
    wanted = set(names)
    return {row["name"]: row["value"] for row in found.collect() if row["name"] in wanted}


def csv_groups(
    spark: SparkSession, folder: str, names: Sequence[str], delimiter: str = ";", glob: str = "*"
) -> list[tuple[T.StructType, list[str]]]:
    """The CSV entries of a folder by header, as (columns, all of them text; names of the entries). Jobs
    grow with the number of different headers, not of files."""
    alike: dict[str, list[str]] = {}
    for name, line in sorted(first_lines(spark, folder, names, glob).items()):
        alike.setdefault(line, []).append(name)
    base = folder.rstrip("/")
    return [(read_csv(spark, f"{base}/{group[0]}", delimiter).schema, group) for group in alike.values()]


def read_json(
    spark: SparkSession, path: str, schema: Schema | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON records, one per line; ``multi_line`` for a file that is one JSON array."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema else reader).json(path)


def read_parquet(spark: SparkSession, path: str, schema: Schema | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def load_files(
    spark: SparkSession,
    folder: str,
    delimiter: str = ";",
    schemas: Schemas | None = None,
    multi_line: bool = False,
) -> dict[str, DataFrame]:
    """One frame per entry of ``folder``, keyed by its name and read by its extension.

    Other formats, and names that Spark's readers pass over (``_`` in front), are
    reported and skipped. ``schemas`` maps entry names or extensions
    to schemas; a JSON file with one needs no inference pass over its data. The headers
    of all CSV files without one are read in one job.
    """
    schemas = dict(schemas or {})
    names = list_entries(spark, folder)
    open_csv = [name for name in names if name.endswith(".csv") and not name.startswith("_")
                and name not in schemas and "csv" not in schemas]
    for columns, group in csv_groups(spark, folder, open_csv, delimiter, "*.csv"):
        schemas |= dict.fromkeys(group, columns)
    frames = {}
    for name in names:
        path, extension = f"{folder.rstrip('/')}/{name}", name.rpartition(".")[2]
        schema = schemas.get(name, schemas.get(extension))
        if name.startswith("_"):
            log.warning("skipped %s: Spark reads no file of such a name", name)
        elif extension == "json":
            frames[name] = read_json(spark, path, schema, multi_line)
        elif extension == "csv":
            frames[name] = read_csv(spark, path, delimiter, schema)
        elif extension == "parquet":
            frames[name] = read_parquet(spark, path, schema)
        else:
            log.warning("skipped %s: no reader for this format", name)
    return frames


def merged_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the columns and fields of both, names compared without case;
    None if a column or field of both has two types."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields = {f.name.lower(): f for f in a.fields}
        for field in b.fields:
            known = fields.setdefault(field.name.lower(), field)
            kind = merged_type(known.dataType, field.dataType)
            if kind is None:
                return None
            fields[field.name.lower()] = T.StructField(known.name, kind)
        return T.StructType(list(fields.values()))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        kind = merged_type(a.elementType, b.elementType)
        return kind and T.ArrayType(kind)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = merged_type(a.keyType, b.keyType), merged_type(a.valueType, b.valueType)
        return T.MapType(key, value) if key and value else None
    return a if a == b else None


def footer_groups(spark: SparkSession, folder: str) -> DataFrame:
    """``entry, columns, files``: the Parquet files below each entry of ``folder``, by the
    columns that their footers name. One job; tasks read footers, no data."""

    def described(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = []
            for uri in frame["uri"]:
                system, place = fs.FileSystem.from_uri(uri)
                with system.open_input_file(place) as file:
                    columns = pq.read_schema(file).remove_metadata()
                found.append(columns.to_string(truncate_metadata=False, show_field_metadata=False))
            yield frame.drop(columns="uri").assign(columns=found)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    files = files.load(folder).select(
        F.col("_metadata.file_path").alias("uri"), F.col("path"), path_below(F.col("path"), folder).alias("entry"))
    named = files.mapInPandas(described, "path string, entry string, columns string")
    return named.groupBy("entry", "columns").agg(F.sort_array(F.collect_list("path")).alias("files"))


def snapshot_parts(spark: SparkSession, folder: str) -> list[tuple[T.StructType, list[str]]]:
    """The Parquet files below a folder as few (columns, paths) as one reader each can take:
    files whose columns agree in type, whatever columns they lack, go together.

    Besides one scan of footers, jobs grow with the number of different schemas, not of
    files or snapshots. Paths are entries of the folder where all their files go together.
    """
    rows = sorted(footer_groups(spark, folder).collect(), key=lambda row: row["files"])
    schemas: dict[str, T.StructType] = {}
    for row in rows:
        if row["columns"] not in schemas:
            schemas[row["columns"]] = spark.read.parquet(literal_path(row["files"][0])).schema
    parts: list[T.StructType] = []
    part_of: dict[str, int] = {}
    for columns, schema in schemas.items():
        for n, part in enumerate(parts):
            if both := merged_type(part, schema):
                parts[n], part_of[columns] = both, n
                break
        else:
            part_of[columns] = len(parts)
            parts.append(schema)
    if len(parts) <= 1:
        return [(part, [folder]) for part in parts]
    places: dict[str, set[int]] = {}
    for row in rows:
        places.setdefault(row["entry"], set()).add(part_of[row["columns"]])
    paths: list[dict[str, None]] = [{} for _ in parts]
    for row in rows:
        whole = len(places[row["entry"]]) == 1
        entry = literal_path(f"{folder.rstrip('/')}/{row['entry']}")
        paths[part_of[row["columns"]]] |= dict.fromkeys([entry] if whole else map(literal_path, row["files"]))
    return [(part, list(found)) for part, found in zip(parts, paths)]


def literal_path(path: str) -> str:
    """A path in which no character is taken for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def has_native_reader(spark: SparkSession, folder: str) -> bool:
    """Whether tasks can open files of the folder's file system themselves."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().toString()
    try:
        fs.FileSystem.from_uri(uri if uri.count("/") > 1 else f"{uri}/")
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
        return False
    return True


def load_snapshots(
    spark: SparkSession,
    folder: str,
    schema: Schema | None = None,
    out: str = "snapshot",
) -> DataFrame:
    """All Parquet files of all snapshot folders as one frame.

    The folder name becomes a column. Schemas of the snapshots are merged; pass a
    schema to spare the pass over all file footers. Where a column's types have no
    common one, files are read by groups of agreeing schemas and the column becomes what
    ``union_frames`` makes of it. On a file system that pyarrow doesn't know, Spark merges
    the schemas, and types that differ raise.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    # File paths are percent-encoded, and a plus sign in them is a plus sign.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))

    def named(frame: DataFrame) -> DataFrame:
        return frame.withColumn(out, path_below(path, folder))

    if schema:
        return named(reader.schema(schema).parquet(folder))
    parts = snapshot_parts(spark, folder) if has_native_reader(spark, folder) else []
    if not parts:
        return named(reader.option("mergeSchema", True).parquet(folder))
    return union_frames([named(reader.schema(columns).parquet(*paths)) for columns, paths in parts])


def register(frames: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Make each frame a temporary view, so that a domain's data can be used from SQL.

    The view is named as the file without its extension; what no name may hold becomes
    an underscore, and a digit in front gets one. Files that would share a name raise.
    """
    views: dict[str, DataFrame] = {}
    for name, frame in frames.items():
        view = re.sub(r"\W", "_", prefix + name.split(".")[0], flags=re.ASCII)
        view = f"_{view}" if view[:1].isdigit() else view
        if view.lower() in map(str.lower, views):
            raise ValueError(f"several files would be the view {view}")
        views[view] = frame
    for view, frame in views.items():
        frame.createOrReplaceTempView(view)
    return list(views)
