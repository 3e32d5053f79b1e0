"""N-gram Jaccard join: count vectors in an R-tree, found by lossless partitions.

1. Shingles of a document are hashed into groups; the counts of 128 fixed groups, or of
   a power of two that is more for a long text, are its point. Points of different
   lengths compare after folding. Documents with equal shingle sets are one class from
   here on.
2. Two sets of sizes a and b that link differ in at most D = (a + b) * 15 / 185 shingles
   (at 85 %). Hashed into more than D groups, they agree in the whole content of a group,
   so classes meet by the hash of a group's content. The number of groups depends on the
   band of sizes; a class that may link into the next band is dealt out there as well.
3. Where classes meet, each is tried against the smallest class only. Pairs whose bound,
   the sum of coordinate minima of their points, is too small are dropped, long ones by
   128 coordinates first and by all they have in common then; the others
   are verified on the shingle sets. Links so far give components.
4. Meeting places that still hold several components get an R-tree over the points
   (boxes of coordinate maxima), folded to 128 coordinates; it yields the pairs between
   components that pass the bound. These are verified too, so no link between different texts is lost, and a
   large group of copies never becomes all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civica.llm.common import bounded_broadcast, components, stored
from civica.llm.hashing import ODD, SPACED, mix, shingle_set

WIDTH = 4
PERCENT = 85
DIMENSIONS = 128
# A coordinate counts at most about so many shingles; beyond it, random sets of equal size
# look alike and the bound lets through every pair of long texts.
CROWD = 8
LEAF = 16
BLOCK = 2_000
SMALL = 4_096
MAX_COUNT = np.iinfo(np.uint8).max
FIRST_PLACES = 24

SKETCH = ("doc_id bigint, text_key bigint, n_shingles bigint, set_id bigint, point binary, "
          "content array<bigint>")


def reach(n: int, percent: int) -> int:
    """The largest size that a set of ``n`` can link with."""
    return 100 * n // percent


def most_different(a: int, b: int, percent: int) -> int:
    """The most shingles in which linked sets of sizes a and b differ."""
    overlap = -(-percent * (a + b) // (100 + percent))
    return a + b - 2 * overlap


def needed_overlap(a, b, percent: int):
    return -(-percent * (a + b) // (100 + percent))


def band_of(n: int) -> tuple[int, int]:
    """Number and largest size of the band of ``n``; bands grow by half."""
    band, top = 0, 1
    while top < n:
        band, top = band + 1, max(top + 1, top * 3 // 2)
    return band, top


def next_top(top: int) -> int:
    return max(top + 1, top * 3 // 2)


def group_contents(found: np.ndarray, percent: int) -> np.ndarray:
    """Where a class meets others: hashes of the contents of its groups, by band.

    A class with so few filled groups that two linked ones could agree in empty groups
    only also gets its smallest shingles, of which linked sets always share one.
    """
    n = len(found)
    if not n or most_different(n, reach(n, percent), percent) <= 0 and reach(n, percent) == n:
        return np.empty(0, np.int64)  # links with equal sets only
    band, top = band_of(n)
    bands = [(band, top)]
    while bands[-1][1] < reach(n, percent):
        bands.append((bands[-1][0] + 1, next_top(bands[-1][1])))
    parts, weak, spread = [], False, mix(found ^ ODD)
    for number, limit in bands:
        widest = max(most_different(limit, limit, percent), most_different(limit, limit - 1, percent), 0)
        groups = widest + 2 + widest // 8
        group = spread % np.uint64(groups)
        order = np.argsort(group, kind="stable")
        ordered = group[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        content = np.add.reduceat(mix(spread[order]), first)
        label = mix(ordered[first] + np.uint64(number << 40))
        parts.append(mix(content * ODD + label))
        partner = min(reach(n, percent), limit)
        weak |= len(first) <= max(most_different(n, m, percent) for m in (n, partner, max(partner - 1, 1)))
    if weak:
        prefix = n - -(-percent * n // 100) + 1
        parts.append(mix(np.sort(spread)[:prefix] + np.uint64(1)))
    return np.concatenate(parts).view(np.int64)


def dimensions_of(n: int) -> int:
    """Coordinates of a point of n shingles: a power of two times DIMENSIONS, by CROWD."""
    size = DIMENSIONS
    while size * CROWD < n:
        size *= 2
    return size


def point_of(found: np.ndarray, dimensions: int) -> np.ndarray:
    counts = np.bincount((mix(found + ODD) % np.uint64(dimensions)).astype(np.int64), minlength=dimensions)
    # A full coordinate keeps its bound safe: it is clipped on both sides alike, and
    # what is cut off is added back by bound().
    return np.minimum(counts, MAX_COUNT).astype(np.uint8)


def sketches(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Size, set identity, point and meeting places of every document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ids, points, contents = [], [], [], []
            for words in SPACED.words(batch.column(2)):
                found = shingle_set(words, width)
                sizes.append(len(found))
                ids.append(int(mix(mix(found).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(found))).view(np.int64)[0])
                           if len(found) else None)
                points.append(point_of(found, dimensions_of(len(found))).tobytes())
                contents.append(group_contents(found, percent))
            offsets = np.cumsum([0, *map(len, contents)])
            flat = np.concatenate([np.empty(0, np.int64), *contents])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(ids, pa.int64()),
                 pa.array(points, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                names=["doc_id", "text_key", "n_shingles", "set_id", "point", "content"])

    return docs.mapInArrow(make, SKETCH)


def class_places(filled: DataFrame, classes: DataFrame) -> DataFrame:
    """``place, node``: where each class meets others, told by its picked document alone, so
    that a group of copies gives its places once (repeated rows of that document again)."""
    picks = bounded_broadcast(classes.select(
        F.col("set_id").alias("_set"), F.col("pick.doc_id").alias("_id"), F.col("pick.text_key").alias("_key")))
    same = (filled["set_id"] == picks["_set"]) & (filled["text_key"] == picks["_key"]) & (
        filled["doc_id"].eqNullSafe(picks["_id"]))
    told = filled.join(picks, same, "left_semi")
    return told.select(F.explode("content").alias("place"), F.col("set_id").alias("node"))


def meetings(places: DataFrame) -> DataFrame:
    """``place, a, b``: at each meeting place every class b with the smallest class a.

    Rows arrive sorted, so a place of any size is one pass that holds a single batch.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_place = last_node = last_first = None
        for batch in batches:
            place, node = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            if not len(place):
                continue
            new = np.concatenate([[place[0] != last_place], place[1:] != place[:-1]])
            same = np.concatenate([[not new[0] and node[0] == last_node],
                                   ~new[1:] & (node[1:] == node[:-1])])
            at = np.maximum.accumulate(np.where(new, np.arange(len(place)), -1))
            first = np.where(at >= 0, node[np.maximum(at, 0)], last_first if last_first is not None else 0)
            keep = ~new & ~same & (node != first)
            last_place, last_node, last_first = place[-1], node[-1], first[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (place, first, node)], names=["place", "a", "b"])

    return (places.repartition("place").sortWithinPartitions("place", "node")
            .mapInArrow(walk, "place bigint, a bigint, b bigint"))


def bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The most shingles that points can share: the sum of coordinate minima.

    A clipped coordinate (a count of 255) says nothing, so it allows any overlap.
    """
    low = np.minimum(x, y)
    total = low.sum(axis=-1, dtype=np.int64)
    return np.where((low == MAX_COUNT).any(axis=-1), np.iinfo(np.int64).max, total)


def folded(point: bytes, dimensions: int) -> np.ndarray:
    """The point as it would be with fewer dimensions; clipped counts stay clipped."""
    counts = np.frombuffer(point, np.uint8)
    if len(counts) == dimensions:
        return counts
    return np.minimum(counts.reshape(-1, dimensions).sum(axis=0, dtype=np.int64), MAX_COUNT).astype(np.uint8)


def points(column: pd.Series) -> np.ndarray:
    """Points of any length, folded to DIMENSIONS."""
    same = b"".join(p if len(p) == DIMENSIONS else folded(p, DIMENSIONS).tobytes() for p in column)
    return np.frombuffer(same, np.uint8).reshape(len(column), -1)


def allows(x: bytes, y: bytes, nx: int, ny: int, percent: int) -> bool:
    """Whether two points allow a link by all coordinates they have in common."""
    common = min(len(x), len(y))
    return common == DIMENSIONS or bool(
        bound(folded(x, common), folded(y, common)) >= needed_overlap(nx, ny, percent))


def passing(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Of pairs ``a, b`` those whose sizes and points allow a link."""
    side = lambda s: classes.select(
        F.col("set_id").alias(s), F.col("n_shingles").alias(f"n{s}"), F.col("point").alias(f"p{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").where(
        f"na * {percent} <= nb * 100 and nb * {percent} <= na * 100").select("a", "b", "na", "nb", "pa", "pb")

    def test(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                ok = bound(points(frame["pa"]), points(frame["pb"])) >= needed_overlap(
                    frame["na"].to_numpy(), frame["nb"].to_numpy(), percent)
                left = frame.loc[ok]
                fine = [allows(*row, percent) for row in zip(left["pa"], left["pb"], left["na"], left["nb"])]
                yield left.loc[np.array(fine, bool), ["a", "b"]]

    return joined.mapInPandas(test, "a bigint, b bigint")


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of stored pairs those whose shingle sets link: 100 * shared >= percent * union."""
    wanted = pairs.select(F.col("a").alias("set_id")).unionAll(pairs.select(F.col("b").alias("set_id"))).distinct()
    wanted = bounded_broadcast(stored(
        wanted.join(classes.select("set_id", "pick.*"), "set_id")
        .select("set_id", F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")), "wanted"))
    same = (docs["text_key"] == wanted["_key"]) & docs["doc_id"].eqNullSafe(wanted["_id"])
    texts = docs.join(wanted, same).select("set_id", "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(words, width).view(np.int64) for words in SPACED.words(batch.column(1))]
            offsets = np.cumsum([0, *map(len, sets)])
            flat = np.concatenate([np.empty(0, np.int64), *sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))],
                names=["set_id", "found"])

    # A repeated row gives its set again; any of them serves.
    sets = texts.dropDuplicates(["set_id"]).mapInArrow(make, "set_id bigint, found array<bigint>")
    sets = stored(sets, "sets")
    side = lambda s: sets.select(F.col("set_id").alias(s), F.col("found").alias(f"f{s}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            a, b = batch.column("fa"), batch.column("fb")
            for i in range(len(batch)):
                x, y = a[i].values.to_numpy(), b[i].values.to_numpy()
                # Sets were sorted as unsigned values; any common order serves here.
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return joined.select("a", "b", "fa", "fb").mapInArrow(test, "a bigint, b bigint")


class CountTree:
    """An R-tree over count vectors, packed by size; boxes keep coordinate maxima."""

    def __init__(self, sizes: np.ndarray, vectors: np.ndarray):
        self.order = np.argsort(sizes, kind="stable")
        self.levels = [(sizes[self.order], sizes[self.order], vectors[self.order])]
        while len(self.levels[-1][0]) > LEAF:
            low, high, top = self.levels[-1]
            cut = np.arange(0, len(low), LEAF)
            self.levels.append((np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut),
                                np.maximum.reduceat(top, cut, axis=0)))

    def search(self, size: int, vector: np.ndarray, percent: int) -> np.ndarray:
        """Rows whose size and point allow a link with the given one."""
        at = np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            low, high, top = (x[at] for x in self.levels[depth])
            fits = (high * 100 >= size * percent) & (low * percent <= size * 100)
            least = needed_overlap(size, np.maximum(low, -(-size * percent // 100)), percent)
            at = at[fits & (bound(top, vector) >= least)]
            if depth:
                at = (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                at = at[at < len(self.levels[depth - 1][0])]
        return self.order[at]


def across(meeting: DataFrame, classes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` of different components that meet somewhere and pass the bound.

    A place's members are dealt into blocks of a bounded size; each pair of blocks is a
    task of its own.
    """
    many = meeting.groupBy("place").agg(F.count(F.lit(1)).alias("_n")).where("_n >= 2")
    rows = meeting.join(many, "place")
    members = rows.select("place", "_n", F.col("b").alias("node")).unionAll(
        rows.select("place", "_n", F.col("a").alias("node")).distinct())
    members = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    members = stored(members, "members")
    open_places = members.groupBy("place").agg(
        F.min("root").alias("_low"), F.max("root").alias("_high")).where("_low < _high").select("place")
    blocks = F.ceil((F.col("_n") + 1) / F.lit(BLOCK)).cast("int")
    open_members = members.join(open_places, "place")
    members = (open_members
               .withColumn("blocks", blocks)
               .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
               .select("place", "node", "root", "own", F.least("own", "other").alias("i"),
                       F.greatest("own", "other").alias("j")))
    # A pair may meet in many places. Each class knows its smallest ones, a fixed number;
    # where two classes share some of these, only the first shared one gives the pair.
    nth = F.row_number().over(Window.partitionBy("node").orderBy("place"))
    open_for = open_members.select("node", "place").withColumn("nth", nth).where(F.col("nth") <= FIRST_PLACES)
    open_for = open_for.groupBy("node").agg(F.collect_list("place").alias("places"))
    members = members.join(classes.select(F.col("set_id").alias("node"), "n_shingles", "point"), "node")
    members = members.join(open_for, "node")

    def tried(frame: pd.DataFrame) -> list[tuple[int, int]]:
        """The pairs of one place and pair of blocks."""
        own, node, root = (frame[c].to_numpy() for c in ("own", "node", "root"))
        whole = frame["point"].to_numpy()
        sizes, vectors = frame["n_shingles"].to_numpy(), points(frame["point"])
        known = [set(x) for x in frame["places"]]
        place, i, j = (frame[c].iloc[0] for c in ("place", "i", "j"))
        left = np.flatnonzero(own == i)
        right = left if i == j else np.flatnonzero(own == j)
        if not len(left) or not len(right):
            return []
        if len(left) * len(right) <= SMALL:  # as one leaf
            met = bound(vectors[left][:, None, :], vectors[right][None, :, :]) >= needed_overlap(
                sizes[left][:, None], sizes[right][None, :], percent)
            pairs = zip(*(x[y].tolist() for x, y in zip((left, right), np.nonzero(met))))
        else:
            index = CountTree(sizes[right], vectors[right])
            pairs = ((x, y) for x in left.tolist() for y in right[index.search(sizes[x], vectors[x], percent)].tolist())
        found = []
        for x, y in pairs:
            if root[x] == root[y] or i == j and node[x] >= node[y]:
                continue
            shared = known[x] & known[y]
            if (not shared or min(shared) == place) and allows(whole[x], whole[y], sizes[x], sizes[y], percent):
                found.append((min(node[x], node[y]), max(node[x], node[y])))
        return found

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            if rest is not None:
                frame = pd.concat([rest, frame], ignore_index=True)
            if not len(frame):
                continue
            keys = frame[["place", "i", "j"]].to_numpy()
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()]
            rest = frame.iloc[cuts[-1]:]  # may go on in the next batch
            found = [pair for a, b in zip(cuts, cuts[1:]) for pair in tried(frame.iloc[a:b])]
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        if rest is not None:
            yield pd.DataFrame(tried(rest), columns=["a", "b"], dtype="int64")

    dealt = members.repartition("place", "i", "j").sortWithinPartitions("place", "i", "j")
    return dealt.mapInPandas(walk, "a bigint, b bigint").distinct()


def linked(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Shingle count and component of every document.

    docs: ``doc_id, text``. Returns ``doc_id, text_key, n_shingles, component_key,
    component_id``, a row for each row of docs. Words are what stands between ASCII white space, A to Z in
    lower case. A set holds the distinct ``width``-word shingles; a text of fewer words
    is one shingle. Documents link when ``100 * shared >= percent * union``;
    component_id is the smallest doc_id reachable by links.

    Null and empty texts have the size 0 and link with nothing. A null doc_id gets a row
    and links others, but no component takes its name from it; a component of null ids
    only has a null name. Repeated rows and ids are all kept. Other columns are not
    read. A row's text_key identifies its text, and component_key its component.
    """
    docs = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string"), F.col("text").isNull()).alias("text_key"),
        F.col("text").cast("string").alias("text"))
    sketch = stored(sketches(docs, width, percent), "sketches")
    filled = sketch.where("n_shingles > 0")
    classes = stored(filled.groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct("doc_id", "text_key")).alias("pick"),
        F.min("n_shingles").alias("n_shingles"), F.min("point").alias("point")), "classes")
    meeting = stored(meetings(class_places(filled, classes)), "meetings")
    first = stored(passing(meeting.select("a", "b").distinct(), classes, percent), "pairs")
    links = stored(verified(first, classes, docs, width, percent), "links")
    roots = components(links)
    rest = across(meeting, classes, roots, percent).join(first, ["a", "b"], "left_anti")
    rest = stored(rest, "rest")
    if not rest.isEmpty():
        more = stored(verified(rest, classes, docs, width, percent), "links")
        if not more.isEmpty():
            roots = components(links.unionAll(more))
    named = classes.select(F.col("set_id").alias("node"), "doc_id").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = stored(named.join(names, "root").select(
        F.col("node").alias("set_id"), F.col("root").alias("component_key"), "component_id"), "names")
    known = filled.select("doc_id", "text_key", "n_shingles", "set_id").join(named, "set_id").select(
        "doc_id", "text_key", "n_shingles", "component_key", "component_id")
    empty = sketch.where("n_shingles = 0").select(
        "doc_id", "text_key", "n_shingles", F.lit(None).cast("bigint").alias("component_key"),
        F.col("doc_id").alias("component_id"))
    return known.unionAll(empty)


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The first document of every component, with all its columns.

    First is the smallest doc_id (a null counts as the smallest), then the smallest hash
    of the text. Repeated rows stay or go together. Texts without words link with
    nothing, so all of them stay.
    """
    found = stored(linked(docs, width, percent).where("n_shingles > 0"), "linked")
    first = found.groupBy("component_key").agg(F.min(F.struct("doc_id", "text_key")).alias("first"))
    dropped = found.join(first, "component_key").where("struct(doc_id, text_key) <> first").select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    dropped = bounded_broadcast(stored(dropped, "dropped"))
    text = docs["text"].cast("string")
    same = docs["doc_id"].cast("bigint").eqNullSafe(dropped["_id"]) & (
        F.xxhash64(text, text.isNull()) == dropped["_key"])
    return docs.join(dropped, same, "left_anti")
