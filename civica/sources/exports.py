"""Writing results out as CSV or JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from civica.operators.ordering import quoted, stored, unused
from civica.sources.collections import write_collection
from civica.sources.files import Schema, csv_groups, list_entries, load_snapshots, read_csv

# A result is one CSV file, written by one task, only while its records take no more.
SINGLE_BYTES = 256 * 1024 * 1024


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def export_csv(
    df: DataFrame, path: str, order: Sequence[str | Column] = (), single_bytes: int = SINGLE_BYTES
) -> None:
    """Write a result as one CSV file with a header, or, where its records take more than
    ``single_bytes``, as several, each with the header, whose names follow the order.

    Either way ``read_csv`` reads the folder as one table. The rows are written to the
    scratch folder first, which counts their bytes as well, so that no task gets a frame
    that hasn't been measured. Beyond the bound they are sorted by range over many tasks;
    rows that are equal in the order are spread by where they stand in their file. In the
    single file and across the several, NULL comes where Spark's sort puts it. An empty
    frame gives a header alone.
    """
    seen = Observation()
    record = F.octet_length(F.to_csv(F.struct(*quoted(df.columns)))) + 1
    kept = stored(df.observe(seen, F.sum(record).alias("bytes")), "export")
    if (seen.get["bytes"] or 0) <= single_bytes:
        single = kept.repartition(1)
        _write_csv(single.sortWithinPartitions(*order) if order else single, path)
    elif order:
        file, row = unused(kept, "file", "row")
        keys = [*order, F.col(file), F.col(row)]
        rows = kept.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
        ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        _write_csv(ordered.select(*quoted(df.columns)), path)
    else:
        _write_csv(kept, path)


def export_all(df: DataFrame, path: str) -> None:
    """Write every row as CSV files with a header, in parallel."""
    _write_csv(df, path)


def export_head(df: DataFrame, path: str, order: Sequence[str], rows: int) -> None:
    """Write the first ``rows`` rows, by ``order``, as one CSV file."""
    _write_csv(df.orderBy(*order).limit(rows), path)


def publish_csv(
    spark: SparkSession,
    path: str,
    name: str,
    store: str | None = None,
    schema: Schema | None = None,
    delimiter: str = ",",
    **options: str,
) -> None:
    """Replace collection ``name`` by the contents of a CSV file."""
    frame = read_csv(spark, path, delimiter, schema)
    write_collection(frame, name, store, append=False, **options)


def _write_json(df: DataFrame, path: str, folder: str, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).partitionBy(folder).option("ignoreNullFields", False)
    writer.json(path)


def parquet_to_json(spark: SparkSession, source: str, target: str) -> None:
    """Convert the Parquet files of all snapshot folders to JSON records, one output
    folder per snapshot, in one job. The input is only read."""
    _write_json(load_snapshots(spark, source), target, "snapshot")


def csv_to_json(
    spark: SparkSession,
    source: str,
    target: str,
    delimiter: str = ",",
    schema: Schema | None = None,
) -> None:
    """Convert the CSV files of a folder to JSON records, one output folder per file.

    Each file's records have the columns of its own header, in its order. Files of
    one header are converted together, so the number of jobs follows that of different
    headers. With a schema all files must have its header; without one values stay text.
    A column named ``file`` would clash with the output folders and raises.
    """
    base = source.rstrip("/")
    if schema is None:
        names = [name for name in list_entries(spark, source) if not name.startswith("_")]
        alike = csv_groups(spark, source, names, delimiter)
        # Many paths take a job to list; a folder of one header is a single path.
        groups = [(columns, [f"{base}/{name}" for name in group] if len(alike) > 1 else source)
                  for columns, group in alike]
    else:
        groups = [(schema, source)]
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.csv$", "")
    frames = [read_csv(spark, paths, delimiter, columns) for columns, paths in groups]
    if any("file" in map(str.lower, frame.columns) for frame in frames):
        raise ValueError("a column is named file, as the output folders are")
    for n, frame in enumerate(frames):
        _write_json(frame.withColumn("file", stem), target, "file", "append" if n else "overwrite")
