"""Saving fitted pipelines, storing their files as rows, and bringing them back."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civica.sources.files import path_below


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every file of a saved model as ``(file, length, content)``, ready to be stored
    as a collection next to the results."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = path_below(F.col("path"), path, ".+")
    return files.select(name.alias("file"), "length", "content")


def restore_model(rows: DataFrame, path: str) -> int:
    """Write ``file, content`` back to files below ``path``, on the executors, and return
    how many. An existing model there must be removed first.

    Each file is written under a name of its own and then moved to its place, so a task
    that runs again leaves the same files. The folder's file system is reached by its URI,
    with what the executors have configured for it. A file name that leads out of the
    folder raises, as do rows without a file and models that are there already.
    """
    spark = rows.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(folder):
        raise ValueError(f"{path} exists")
    uri = re.sub(r"^file:/(?!/)", "file:///", system.makeQualified(folder).toUri().toString())

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, base = fs.FileSystem.from_uri(uri)
        for frame in frames:
            for name, content in zip(frame["file"], frame["content"]):
                parts = (name or "").split("/")
                if not name or ".." in parts or "" in parts:
                    raise ValueError(f"{name!r} is no file of a model")
                place = f"{base}/{name}"
                target.create_dir(place.rpartition("/")[0], recursive=True)
                draft = f"{place.rpartition('/')[0]}/.{parts[-1]}.{uuid.uuid4().hex}"
                with target.open_output_stream(draft) as out:
                    out.write(content)
                target.move(draft, place)
            yield pd.DataFrame({"n": [len(frame)]})

    written = rows.select("file", "content").mapInPandas(write, "n bigint").agg(F.sum("n")).first()[0]
    return written or 0
