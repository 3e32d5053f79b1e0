"""Named collections: where formatted data and results are kept.

A collection is a folder of files under ``store``, a table of the session catalogue
when ``store`` is None, or, with another ``fmt``, whatever that connector makes of
its options. Credentials belong to the caller's options. Failures are raised.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

FILE_FORMATS = {"parquet", "orc", "json", "csv"}


def _target(name: str, store: str | None, fmt: str) -> dict[str, str]:
    if fmt in FILE_FORMATS:
        return {"path": f"{store.rstrip('/')}/{name}"}
    return {"collection": name}


def read_collections(
    spark: SparkSession,
    names: Iterable[str],
    store: str | None = None,
    fmt: str = "parquet",
    **options: str,
) -> dict[str, DataFrame]:
    """A frame for each named collection."""
    if store is None and fmt in FILE_FORMATS:
        return {name: spark.table(name) for name in names}
    return {
        name: spark.read.format(fmt).options(**options, **_target(name, store, fmt)).load()
        for name in names
    }


def write_collection(
    df: DataFrame,
    name: str,
    store: str | None = None,
    append: bool = True,
    fmt: str = "parquet",
    **options: str,
) -> None:
    """Append to a collection, or replace it when ``append`` is false."""
    writer = df.write.format(fmt).mode("append" if append else "overwrite").options(**options)
    if store is None and fmt in FILE_FORMATS:
        writer.saveAsTable(name)
    else:
        writer.options(**_target(name, store, fmt)).save()


def create_collection(
    spark: SparkSession, name: str, schema: T.StructType | str, store: str | None = None, fmt: str = "parquet"
) -> None:
    """Create an empty collection of the given columns unless it exists; what is in an
    existing one stays. Below a store it is a folder of a format that keeps types."""
    if store is None:
        if not spark.catalog.tableExists(name):
            spark.createDataFrame([], schema).write.saveAsTable(name)
    elif fmt in ("parquet", "orc"):
        empty = spark.createDataFrame([], schema)
        empty.write.format(fmt).mode("ignore").save(**_target(name, store, fmt))
    else:
        raise ValueError(f"an empty collection in {fmt} would lose its column types")


def drop_collection(spark: SparkSession, name: str, store: str | None = None) -> None:
    """Drop a collection if it exists: a catalogue table, or a folder below ``store`` through the
    file system that Spark uses for it."""
    if store is None:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})
        return
    if not name.strip("/."):
        raise ValueError("a collection needs a name")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{store.rstrip('/')}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
