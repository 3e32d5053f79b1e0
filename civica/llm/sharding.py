"""Shards by jump consistent hashing; DataFrame functions only.

A row's key walks through rising shard numbers: from shard b a 64-bit generator draws the
next number of shards at which the key would move, until that passes the shards there are.
The walk doesn't depend on where it stops, so with more shards a key stays where it
is or moves to one of the new ones, and no table of a ring is kept.

The generator multiplies modulo 2**64. Spark's products raise when they pass 64 bits, so a
state is held as three limbs of 22, 22 and 20 bits.

Slots number the rows of a shard by doc_id without gaps. They come from a sort by range
with counts carried between partitions, so neither a shard nor the copies of a row meet in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civica.operators.ordering import numbered

SHARDS = 16
LIMB, TOP = 22, 20
# Fixed value: the multiplier of the published generator.
FACTOR = 2862933555777941757
# A walk over n shards makes about ln n steps; one that isn't done after these is
# walked again, to its end.
STEPS = 64


def _limbs(value: int) -> tuple[int, int, int]:
    return value & (1 << LIMB) - 1, value >> LIMB & (1 << LIMB) - 1, value >> 2 * LIMB


def jump_hash(key: Column, shards: int) -> Column:
    """The shard of a 64-bit key among ``shards``, as the published algorithm gives it.
    A null key counts as 0."""
    if not 0 < shards < 1 << 31:
        raise ValueError("the number of shards must be from 1 to 2**31 - 1")
    long = lambda x: F.lit(x).cast("bigint")
    key = F.coalesce(key.cast("bigint"), long(0))
    mask, top = long((1 << LIMB) - 1), long((1 << TOP) - 1)
    f0, f1, f2 = (long(x) for x in _limbs(FACTOR))
    start = F.struct(
        key.bitwiseAND(mask).alias("k0"), F.shiftright(key, LIMB).bitwiseAND(mask).alias("k1"),
        F.shiftrightunsigned(key, 2 * LIMB).alias("k2"), long(0).alias("at"), long(0).alias("next"))

    def step(s: Column, _: Column) -> Column:
        def carried(x: Column) -> Column:
            low = x["k0"] * f0 + 1
            middle = x["k0"] * f1 + x["k1"] * f0 + F.shiftright(low, LIMB)
            high = x["k0"] * f2 + x["k1"] * f1 + x["k2"] * f0 + F.shiftright(middle, LIMB)
            return F.struct(low.bitwiseAND(mask).alias("k0"), middle.bitwiseAND(mask).alias("k1"),
                            high.bitwiseAND(top).alias("k2"), x["next"].alias("at"))

        def drawn(x: Column) -> Column:
            # The upper 31 bits of the state, plus 1.
            bits = F.shiftleft(x["k2"], 64 - 33 - TOP).bitwiseOR(F.shiftright(x["k1"], 33 - LIMB)) + 1
            ahead = F.floor((x["at"] + 1).cast("double") * (F.lit(float(1 << 31)) / bits.cast("double")))
            return F.struct(x["k0"], x["k1"], x["k2"], x["at"], ahead.cast("bigint").alias("next"))

        # Lambdas see no common subexpressions, so a step's state goes through transforms
        # of one element.
        moved = F.get(F.transform(F.transform(F.array(s), carried), drawn), F.lit(0))
        return F.when(s["next"] < shards, moved).otherwise(s)

    def walk(steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)

    end = walk(min(shards, STEPS))
    if shards > STEPS:
        end = F.when(end["next"] < shards, walk(shards)).otherwise(end)
    return end["at"].cast("int")


def text_size(text: Column) -> Column:
    """Bytes of a text in UTF-8 (none for a null), plus 1 for the row itself."""
    return (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + 1).cast("bigint")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(F.encode(text.cast("string"), "UTF-8"), F.lit(b"")))


def sharded(docs: DataFrame, shards: int = SHARDS, more: int = 1) -> DataFrame:
    """Every document's shard and slot, and its shard once there are ``more`` shards.

    docs: ``doc_id, text``, or any table whose doc_id is a whole number. Returns
    ``doc_id, size, text_crc32, law, shard, slot, grown_shard``, a row for each row of
    docs. shard depends on doc_id and the number of shards alone; grown_shard equals it
    or is a new shard. slot counts the rows of a shard from 0 without gaps, by
    doc_id, then size, then crc32; rows equal in all three get any order among them.

    A null doc_id goes where 0 goes and its slots come first. A null text has the size 1
    and the crc32 of an empty one. Repeated ids and rows are all kept, each with a slot of
    its own. Texts of any length are read once, for their size and crc32; other
    columns are not read. An empty table gives no rows.
    """
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_size(F.col("text")).alias("size"),
        text_crc32(F.col("text")).alias("text_crc32"), F.lit("key").alias("law"))
    keyed = keyed.withColumns({
        "shard": jump_hash(F.col("doc_id"), shards), "grown_shard": jump_hash(F.col("doc_id"), shards + more)})
    found = numbered(keyed, ["doc_id", "size", "text_crc32"], ["shard"], "slot")
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def placed(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", out: str = "shard") -> DataFrame:
    """The rows of docs with their shard as column ``out`` (a former one is replaced), in one
    pass without a shuffle. A key that is no whole number is hashed first."""
    integral = {"tinyint", "smallint", "int", "bigint"}
    column = F.col(f"`{key}`")
    keyed = column if dict(docs.dtypes)[key] in integral else F.when(column.isNotNull(), F.xxhash64(column))
    return docs.withColumn(out, jump_hash(keyed, shards))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """One folder of Parquet files for each shard. Each task writes what it reads, sorted by
    shard, so nothing is shuffled and copies of a row meet nowhere."""
    placed(docs, shards).sortWithinPartitions("shard").write.mode("overwrite").partitionBy("shard").parquet(path)
