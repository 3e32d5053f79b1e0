"""A corpus pipeline: quality, lines, near duplicates, benchmark leaks, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civica.llm import decontamination, jaccard_join, line_dedup, quality, sentencepiece_bpe
from civica.llm.common import read_table, stored


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from labelled documents."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand earlier in the corpus; n_chars follows the text.
    Documents that lose every filled line go."""
    found = line_dedup.deduplicated(docs)
    left = found.where("n_lines = 0 or n_kept > 0")
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8."""
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.decontaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids under merge dropout."""
    return sentencepiece_bpe.encoded(docs)


STAGES = [
    ("quality", drop_low_quality),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("tokens", tokenize),
]

# The stages learn, follow edit distances and split words, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
