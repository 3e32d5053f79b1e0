"""Joins of a large left side with a right side of unknown size.

Building a join starts no job. Catalyst broadcasts a side that its files show to be small; any
other join shuffles, and adaptive execution decides from the bytes actually written: it
broadcasts a side below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits
the partitions of hot keys, on both sides of an inner join into a grid of tasks.

A caller who gives a bound has the right side measured instead, by a job: below the bound it is
broadcast without a shuffle of the left side; beyond it the few keys that hold a
large share of the left side are spread over many tasks by a salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 4_000_000
BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD = 16
HOT_SHARE = 0.02
HOT_COPIES = 64
SALT = "__salt"
HASH = "__hash"

# Join types that return right rows without a match.
FULL = {"full", "fullouter", "outer"}
KEEPS_RIGHT = FULL | {"right", "rightouter"}


def _width(field: T.StructField) -> Column:
    """Bytes of one value, near enough for a broadcast decision."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) + 16
    return F.lit(8)


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a frame with one aggregate (no rows shuffled) against the bound."""
    width = sum((_width(field) for field in df.schema.fields), F.lit(ROW_OVERHEAD))
    size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(width).alias("bytes")).first()
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def _hashable_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys such that equal ones hash alike on both sides: whole numbers of different
    width as the widest. None at all where other types differ."""
    parts = []
    for key in keys:
        types = [df.schema[key].dataType for df in (left, right)]
        if types[0] == types[1]:
            parts.append(F.col(key))
        elif all(isinstance(t, T.IntegralType) for t in types):
            parts.append(F.col(key).cast("bigint"))
        else:
            return []
    return parts


def _hot_hashes(df: DataFrame, keys: Sequence[str | Column], share: float) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows, in one pass.

    The frequent-items sketch has a fixed size and finds every item of such a share;
    no key is shuffled. A wrong guess would cost time, never a row.
    """
    most = int(1 / share)
    top = F.expr(f"approx_top_k({HASH}, {most}, {100 * most})").alias("top")
    hashed = df.select(F.xxhash64(*keys).alias(HASH))
    row = hashed.agg(top, F.count(F.lit(1)).alias("rows")).first()
    return [item["item"] for item in row["top"] or [] if item["count"] >= share * row["rows"]]


def spread_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] = (),
    share: float = HOT_SHARE,
    copies: int = HOT_COPIES,
) -> DataFrame:
    """Equi-join in which each hot key of the left side is spread over ``copies`` tasks.

    Left rows of a hot key take one of ``copies`` salts and the matching right rows
    are repeated once per salt, so every pair still meets exactly once. A hot NULL key
    is spread as well. Joins that keep unmatched right rows are left to adaptive
    execution. The salt is a hash of the row, or of the columns in ``spread_by``
    (an identifier, say, which saves reading the others), so that a retried task
    computes the same one.
    """
    # A repeated right row that meets no left row would come out once for every salt.
    if how.lower().replace("_", "") in KEEPS_RIGHT:
        return left.join(right, list(keys), how)
    hashable_keys = _hashable_keys(left, right, keys)
    hot = _hot_hashes(left, hashable_keys, share) if hashable_keys else []
    if not hot:
        return left.join(right, list(keys), how)
    is_hot = F.xxhash64(*hashable_keys).isin(hot)
    hashable = [f.name for f in left.schema.fields if not isinstance(f.dataType, T.MapType)]
    hashed = F.hash(*[f"`{name}`" for name in spread_by or hashable])
    salt = F.pmod(hashed, F.lit(copies))
    salted = left.withColumn(SALT, F.when(is_hot, salt).otherwise(F.lit(0)))
    every = F.sequence(F.lit(0), F.lit(copies - 1))
    salts = F.when(is_hot, every).otherwise(F.array(F.lit(0)))
    repeated = right.withColumn(SALT, F.explode(salts))
    return salted.join(repeated, [*keys, SALT], how).drop(SALT)


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] = (),
    max_rows: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a large left side with a right side of unknown size on shared key names.

    Right columns that the left side already has are left out, so no name comes out
    twice. Matching is many-to-many, as in any equi-join. With ``max_rows`` the right side is
    measured against the bounds first, see above.
    """
    extra = [name for name in right.columns if name not in left.columns]
    wanted = right.select(*keys, *extra)
    if max_rows is None:
        return adaptive_join(left, wanted, keys, how)
    if fits_broadcast(wanted, max_rows, max_bytes):
        return left.join(F.broadcast(wanted), list(keys), how)
    return spread_join(left, wanted, keys, how, spread_by)


def adaptive_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """An equi-join whose hot keys adaptive execution can split, whatever the join type.

    It splits no full outer join, so that becomes a left join and, below it, the right rows
    whose key the left side lacks; a hot key of either side is split in its part.
    """
    if how.lower().replace("_", "") not in FULL:
        return left.join(right, list(keys), how)
    present = left.select(*keys).distinct()
    alone = right.join(present, list(keys), "left_anti")
    return left.join(right, list(keys), "left").unionByName(alone, allowMissingColumns=True)


def attach_lookup(
    df: DataFrame,
    lookup: DataFrame,
    raw: str,
    lookup_raw: str,
    lookup_name: str,
    out: str,
    max_rows: int | None = None,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace raw name ``raw`` by the reconciled name, as column ``out``.

    A left join: rows without a match keep a NULL name, and a lookup listing a raw
    name twice gives two rows. The raw column and any former ``out`` are dropped.
    """
    key = "__raw_name"
    kept = [name for name in df.columns if name not in (raw, out)]
    facts = df.select(*[F.col(f"`{name}`") for name in kept], F.col(f"`{raw}`").alias(key))
    names = lookup.select(F.col(lookup_raw).alias(key), F.col(lookup_name).alias(out))
    joined = join_on_keys(facts, names, [key], "left", max_rows=max_rows, max_bytes=max_bytes)
    return joined.drop(key)
