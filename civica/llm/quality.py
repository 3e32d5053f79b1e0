"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from the bytes and words of whole texts, vectorised per Arrow batch. The
trees are grown by Spark's own histogram booster on a bounded sample of labelled rows,
then flattened into arrays (feature, threshold, children, value) that every task walks
for all rows of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.llm.common import bounded_broadcast, stored
from civica.llm.hashing import SPACED, shingles, text_bytes

# At most about this many labelled rows (a share of them, chosen by hash) are learned from.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 20, 4, 64
THRESHOLD = 0.3
FEATURES = (
    "log_bytes", "log_words", "word_length", "lower", "upper", "digit", "space", "sentence_mark", "other_mark",
    "non_ascii", "line_break", "distinct_words", "distinct_pairs", "repeated_next", "top_word", "pipe", "symbol",
    "line_words",
)


def _classes() -> np.ndarray:
    """For every byte its class; a class is counted per text."""
    kind = np.full(256, 5)  # other marks
    kind[ord("a"): ord("z") + 1], kind[ord("A"): ord("Z") + 1], kind[ord("0"): ord("9") + 1] = 0, 1, 2
    kind[[0x20, 0x09, 0x0D]] = 3
    kind[[ord(c) for c in ".,;:?'\"()-"]] = 4
    kind[0x80:], kind[ord("\n")], kind[ord("|")] = 6, 7, 8
    kind[[ord(c) for c in "!#$%&*+<=>@\\^_`{}~[]"]] = 9
    return kind


CLASSES = _classes()


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of features per text; all zero for a text without bytes."""
    data, offsets = text_bytes(texts)
    rows = np.zeros((len(offsets) - 1, len(FEATURES)))
    for i, words in enumerate(SPACED.words(texts)):
        size = int(offsets[i + 1] - offsets[i])
        if not size:
            continue
        count = np.zeros(10)
        for begin in range(int(offsets[i]), int(offsets[i + 1]), 1 << 20):
            count += np.bincount(CLASSES[data[begin: min(begin + (1 << 20), int(offsets[i + 1]))]], minlength=10)
        n = len(words)
        share = count / size
        row = rows[i]
        row[:3] = np.log1p(size), np.log1p(n), size / max(n, 1)
        row[3:11] = share[[0, 1, 2, 3, 4, 5, 6, 7]]
        if n:
            _, times = np.unique(words, return_counts=True)
            row[11], row[14] = len(times) / n, times.max() / n
        if n > 1:
            row[12] = len(np.unique(shingles(words, 2))) / (n - 1)
            row[13] = (words[1:] == words[:-1]).mean()
        row[15], row[16], row[17] = share[8], share[9], n / (count[7] + 1)
    return rows


@dataclass(frozen=True)
class Trees:
    """Boosted trees as arrays; a leaf points at itself. The margin adds up the values."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not len(rows):
            return np.empty(0)
        node = np.tile(self.roots, (len(rows), 1))
        at = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            low = rows[at, self.feature[node]] <= self.threshold[node]
            node = np.where(low, self.left[node], self.right[node])
        margin = self.base + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-2 * np.clip(margin, -300, 300)))


def constant(probability: float) -> Trees:
    p = min(max(probability, 1e-6), 1 - 1e-6)
    none = np.empty(0, np.int64)
    return Trees(none, np.empty(0), none, none, np.empty(0), none, 0, float(np.log(p / (1 - p)) / 2))


def flattened(model) -> Trees:
    """The arrays of a fitted booster."""
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def add(node, weight: float) -> int:
        k = len(feature)
        for column, x in ((feature, 0), (threshold, np.inf), (left, k), (right, k), (value, weight * node.prediction())):
            column.append(x)
        if node.subtreeDepth() > 0:
            split = node.split()
            feature[k], threshold[k], value[k] = split.featureIndex(), split.threshold(), 0.0
            left[k], right[k] = add(node.leftChild(), weight), add(node.rightChild(), weight)
        return k

    depth = 0
    for tree, weight in zip(model.trees, model.treeWeights):
        roots.append(add(tree._java_obj.rootNode(), weight))
        depth = max(depth, tree.depth)
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value),
                 np.array(roots), depth, 0.0)


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, trees: int = TREES) -> Trees:
    """Learn ``labels.quality`` from the texts of labelled documents that aren't held out.

    Labels other than 0 and 1 are left out; a document labelled twice counts as 1 if any
    label is. With one class only, or none, the score is the share of 1 (0.5 for none).
    """
    wanted = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out())
    wanted = wanted.groupBy(F.col("doc_id").cast("bigint").alias("_id")).agg(
        F.max("quality").cast("double").alias("label"))
    n = wanted.count()
    if n > sample_rows:
        share = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < int((1 << 30) * sample_rows / n)
        wanted = wanted.where(share)
    wanted = bounded_broadcast(stored(wanted, "labels"))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("_doc"), F.col("text").cast("string").alias("text"))
    rows = rows.join(wanted, rows["_doc"] == wanted["_id"]).select("label", "text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(batch.column(1))
            flat = pa.array(found.ravel())
            offsets = pa.array(np.arange(len(found) + 1) * len(FEATURES), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, flat)], names=["label", "features"])

    sample = stored(rows.mapInArrow(measure, "label double, features array<double>"), "sample")
    seen = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(seen) < 2:
        return constant(next(iter(seen), 0.5))
    booster = GBTClassifier(maxIter=trees, maxDepth=DEPTH, maxBins=BINS, stepSize=0.3, minInstancesPerNode=5,
                            seed=7, cacheNodeIds=False)
    return flattened(booster.fit(sample.select("label", array_to_vector("features").alias("features"))))


def scored(docs: DataFrame, model: Trees, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, text_key, held_out, score, predicted`` for every row of docs."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.xxhash64(F.col("text").cast("string"), F.col("text").isNull()).alias("text_key"),
                       F.col("text").cast("string").alias("text"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.scores(statistics(batch.column(2)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["doc_id", "text_key", "score"])

    result = rows.mapInArrow(score, "doc_id bigint, text_key bigint, score double")
    return result.select("doc_id", "text_key", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Quality of every document: ``doc_id, held_out, score, predicted``.

    docs: ``doc_id, text``; labels: ``doc_id, quality``. score (0 to 1) is higher where
    label 1 is likelier; predicted is 1 from 0.3 on. Only the text enters a score.

    Null and empty texts have all-zero statistics and get the score of those. A null
    doc_id is kept and counts as not held out, and its label is not used. Repeated rows
    are scored alike. Empty labels give 0.5 everywhere. Other columns are not read.
    """
    return scored(docs, fitted(docs, labels, **options)).drop("text_key")


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents predicted 1, with all their columns."""
    found = scored(docs, fitted(docs, labels, **options))
    rejected = bounded_broadcast(stored(found.where("predicted = 0").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "rejected"))
    text = docs["text"].cast("string")
    same = docs["doc_id"].cast("bigint").eqNullSafe(rejected["_id"]) & (
        F.xxhash64(text, text.isNull()) == rejected["_key"])
    return docs.join(rejected, same, "left_anti")
