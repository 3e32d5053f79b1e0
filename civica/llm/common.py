"""Helpers shared by the operators: tables, scratch tables, words, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civica.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A lookup side is broadcast only while its counted rows stay at or below this; beyond
# it the same join shuffles.
BROADCAST_ROWS = 1_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared scratch folder and return the table read back.

    This cuts the lineage, and unlike a cache it outlives any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def row_key(*columns: str) -> Column:
    """A 64-bit identity of a row's values; repeated rows share it. Hashing skips nulls,
    so what is null is hashed as well."""
    flags = [F.col(c).isNull() for c in columns]
    return F.xxhash64(*[F.col(c) for c in columns], *flags)


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """A stored frame, hinted for broadcast if it has at most ``limit`` (narrow) rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the links ``a``-``b`` (long, both ways meant).

    Returns ``node, root`` for every node that has a link; root is the smallest node
    reachable. Alternates two steps until nothing changes: every node's larger
    neighbours take its smallest neighbour, then its smaller ones do. Each step is a
    shuffle of the links; every round is written to the scratch folder. A node with very
    many links costs one running minimum, never a list.
    """
    spark = edges.sparkSession

    def both_ways(links: DataFrame) -> DataFrame:
        return links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def tied(links: DataFrame, smallest: DataFrame, larger: bool) -> DataFrame:
        """Neighbours of each node tied to the smallest of them (or the node itself)."""
        side = F.col("b") > F.col("a") if larger else F.col("b") <= F.col("a")
        return (links.where(side).join(smallest, "a")
                .select(F.col("b").alias("a"), F.col("m").alias("b")))

    def smallest(links: DataFrame) -> DataFrame:
        return links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))

    current = stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        # Larger neighbours to the smallest neighbour.
        links = both_ways(current)
        large = tied(links, smallest(links), True).where("a <> b").distinct()
        large = stored(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), name)
        # Every node and its smaller neighbours to the smallest of those.
        low = smallest(large)
        small = tied(large, low, False).unionAll(low.select("a", F.col("m").alias("b")))
        current = stored(small.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
        seen = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == state:
            break
        state = seen
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionAll(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
