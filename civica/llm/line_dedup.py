"""Line dedup by a segment-partition edit join; DataFrame functions only.

Two lines within ``edits`` edits agree in one of ``edits + 1`` segments, up to a shift
that their lengths bound. Each line gives the hashes of its own segments and, for every
shorter length that could match, of the substrings that could equal a segment of such a
line; lines meet where a hash is equal.

1. Where lines meet, each is tried against the first of them; pairs verified by a banded
   bit-parallel edit distance are links, and links give classes.
2. Meeting places that still hold several classes are looked at again across classes,
   so that no link between different lines is lost. Only pairs whose character counts
   allow a link leave that join.
3. Of each class the first line in the corpus stays. Positions are gathered by line and
   by document, so a line that stands everywhere is a running minimum, not a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civica.llm.common import bounded_broadcast, components, stored

EDITS = 2
MIN_CHARS = 16
COUNTED = ("eE", "tT", "aA", "oO", "iI", "nN", "sS", "rR", "hH", "lL", "dD", "uU", " ")
WHITE = " \t\r\f\x0b"


def shifts(i: int, longer: int, edits: int) -> range:
    """By how much a substring of a line may lie beside segment i of one that is shorter
    by ``longer``: what lies before and behind must match in the edits that are left."""
    before, behind = i, edits - i
    return range(max(-before, longer - behind), min(before, longer + behind) + 1)


def meeting_hashes(lines: DataFrame, edits: int) -> DataFrame:
    """``line_id, place``: the hashes by which lines meet. lines: ``line_id, line``.

    A line is taken in UTF-32, where any character is found without a walk. Each row of
    a small table says which segment i of a line that is shorter by ``longer`` is looked
    for at which shift; the segment's start and size follow from that length, the last
    segments being the longer ones.
    """
    parts = edits + 1
    table = F.array(*[
        F.struct(F.lit(longer).alias("longer"), F.lit(i).alias("i"), F.lit(shift).alias("shift"))
        for longer in range(parts) for i in range(parts) for shift in shifts(i, longer, edits)])
    coded = lines.select("line_id", F.encode("line", "UTF-32").alias("code"))
    rows = coded.select("line_id", "code", (F.octet_length("code") / 4).cast("int").alias("length"), F.inline(table))
    rows = rows.withColumn("other", F.col("length") - F.col("longer"))
    rows = rows.withColumn("short", parts - F.pmod("other", F.lit(parts)))  # segments of the smaller size
    rows = rows.withColumn("size", F.expr(f"other div {parts}").cast("int"))
    rows = rows.withColumn("start", F.col("size") * F.col("i") + F.greatest(F.col("i") - F.col("short"), F.lit(0)) + F.col("shift"))
    rows = rows.withColumn("size", F.col("size") + F.when(F.col("i") >= F.col("short"), 1).otherwise(0))
    rows = rows.where("start >= 0 and start + size <= length and size > 0")
    piece = F.substring("code", F.col("start") * 4 + 1, F.col("size") * 4)
    return rows.select("line_id", F.xxhash64(piece, "i", "other").alias("place"))


def cores(pairs: DataFrame, a: str, b: str, edits: int) -> DataFrame:
    """Columns a and b as characters, without their common ends but for ``edits`` of
    each; that leaves their distance as it is."""
    steps = F.lit([1 << k for k in range(17, -1, -1)])

    def common(x: str, y: str) -> Column:
        shorter = F.least(F.length(x), F.length(y))
        return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
            (n + step <= shorter) & (F.substring(F.col(x), n + 1, step) == F.substring(F.col(y), n + 1, step)),
            n + step).otherwise(n))

    for _ in range(2):  # what is cut from the front, then, reversed, from the back
        pairs = pairs.withColumn("_cut", F.greatest(common(a, b) - edits, F.lit(0)))
        pairs = pairs.withColumns({c: F.reverse(F.substring(F.col(c), F.col("_cut") + 1, F.length(c))) for c in (a, b)})
    return pairs.drop("_cut").withColumns({c: F.split(F.col(c), "") for c in (a, b)})


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether two arrays of characters are within ``edits`` edits: a banded bit-parallel
    distance. Both should be plain columns, as every step looks into them.

    The columns of the distance matrix are walked along the characters of b. A word holds
    the 2 * edits + 1 rows around the diagonal as bits, the lowest row of the band on
    top; plus and minus say where a cell is one more or less than the one above it. The
    value at the top bit is followed down the diagonal until the last row, then along it.
    Both must hold at least ``edits`` characters.
    """
    width = 2 * edits + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    long = lambda x: F.lit(x).cast("bigint")
    flip = lambda x: x.bitwiseXOR(long(full))

    def matches(char: Column, i: Column) -> Column:
        bits = long(0)
        for k in range(width):
            row = i + (k - edits)
            same = F.when((row >= 0) & (row < size), F.get(a, row) == char).otherwise(False)
            bits = bits.bitwiseOR(F.when(same, long(1 << k)).otherwise(long(0)))
        return bits

    bit = F.lit([1 << k for k in range(width)]).cast("array<bigint>")
    size = F.size(a)
    start = F.struct(long(((1 << (edits + 1)) - 1) << edits).alias("plus"), long(0).alias("minus"),
                     F.lit(edits).cast("int").alias("value"))

    def step(s: Column, x: Column) -> Column:
        i = x["i"]
        # From there on the last value can't come down to edits again.
        far = s["value"] > 3 * edits
        # Lambdas see no common subexpressions, so each step's words go through a nested
        # one-element transform.
        def cell(m: Column) -> Column:
            sums = (m.bitwiseAND(s["plus"]) + s["plus"]).bitwiseAND(long(full))
            return sums.bitwiseXOR(s["plus"]).bitwiseOR(m).bitwiseOR(s["minus"])

        def after(d: Column) -> Column:
            more = s["minus"].bitwiseOR(flip(d.bitwiseOR(s["plus"])))
            less = d.bitwiseAND(s["plus"])
            down = F.shiftrightunsigned(d, 1)
            last = F.get(bit, F.greatest(F.least(size - 1 - i + edits, F.lit(width - 1)), F.lit(0)))
            diagonal = i + edits <= size - 1
            change = F.when(diagonal, F.when(d.bitwiseAND(long(top)) == 0, 1).otherwise(0)).otherwise(
                F.when(more.bitwiseAND(last) != 0, 1).otherwise(0) - F.when(less.bitwiseAND(last) != 0, 1).otherwise(0))
            return F.struct(
                less.bitwiseOR(flip(down.bitwiseOR(more))).alias("plus"), down.bitwiseAND(more).alias("minus"),
                (s["value"] + change).cast("int").alias("value"))

        words = F.transform(F.array(matches(x["c"], i)), cell)
        return F.when(far, s).otherwise(F.get(F.transform(words, after), F.lit(0)))

    characters = F.transform(b, lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    distance = F.aggregate(characters, start, step, lambda s: s["value"])
    near = F.abs(size - F.size(b)) <= edits
    return F.when(near, distance <= edits).otherwise(False)


def bag(line: Column) -> Column:
    """How often some characters stand in a line, and all others. An edit changes two of
    the counts by one at most, so lines whose counts are further apart are no pair."""
    size = F.length(line)
    counts = [size - F.length(F.translate(line, c, "")) for c in COUNTED]
    return F.array(*counts, F.length(F.translate(line, "".join(COUNTED), "")))


def first_in_corpus() -> Column:
    """Where a line stands first: documents by id (null first), then text, then position."""
    return F.min(F.struct("doc_id", "key", "pos")).alias("first")


def trimmed(line: Column) -> Column:
    """A line without white space at its ends; spaces alone go the quick way."""
    spaces = F.trim(line)
    ends = F.concat(F.left(spaces, F.lit(1)), F.right(spaces, F.lit(1)))
    return F.when(ends.rlike(r"[\t\r\f\x0b]"), F.trim(line, F.lit(WHITE))).otherwise(spaces)


def exploded(docs: DataFrame) -> DataFrame:
    """``doc_id, key, pos, line, line_id`` of all lines that hold more than white space."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64(F.col("text").cast("string")).alias("key"),
        F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("pos", "raw"))
    rows = rows.select("doc_id", "key", "pos", trimmed(F.col("raw")).alias("line"))
    return rows.where("line <> ''").select("doc_id", "key", "pos", "line", F.xxhash64("line").alias("line_id"))


def line_links(lines: DataFrame, edits: int, min_chars: int) -> DataFrame:
    """``node, root``: classes of different lines linked by at most ``edits`` edits."""
    long_lines = lines.where(F.length("line") >= min_chars)
    places = meeting_hashes(long_lines.select("line_id", "line"), edits)
    sorted_place = Window.partitionBy("place").orderBy("line_id")
    rows = places.select(
        "place", F.col("line_id").alias("b"),
        F.first("line_id").over(sorted_place.rowsBetween(Window.unboundedPreceding, 0)).alias("a"),
        F.lag("line_id").over(sorted_place).alias("before"))
    meeting = stored(rows.where("a <> b and b <> before").select("place", "a", "b"), "meetings")

    # The lines that met anything, with their texts, in one pass.
    wanted = meeting.select(F.col("a").alias("line_id")).unionAll(meeting.select("b")).distinct()
    wanted = bounded_broadcast(stored(wanted, "wanted"))
    texts = long_lines.select("line_id", "line").join(wanted, "line_id").groupBy("line_id").agg(F.min("line").alias("line"))
    texts = stored(texts.withColumn("bag", bag(F.col("line"))), "lines")

    def verified(pairs: DataFrame) -> DataFrame:
        side = lambda s: texts.select(F.col("line_id").alias(s), F.col("line").alias(f"line_{s}"))
        both = pairs.join(side("a"), "a").join(side("b"), "b")
        both = cores(both.where(F.abs(F.length("line_a") - F.length("line_b")) <= edits), "line_a", "line_b", edits)
        # Written, so that the distance finds characters and doesn't split lines at every step.
        both = stored(both, "cores")
        return both.where(within_edits(F.col("line_a"), F.col("line_b"), edits)).select("a", "b")

    first = stored(meeting.select("a", "b").distinct(), "pairs")
    links = stored(verified(first), "links")
    roots = components(links)
    # Places of three lines or more that are not one class yet.
    many = meeting.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where("n >= 2").select("place")
    inside = meeting.join(many, "place").select("place", F.col("b").alias("node")).join(roots, "node", "left")
    inside = stored(inside.select("place", "node", F.coalesce("root", "node").alias("root")), "members")
    mixed = inside.groupBy("place").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    left = stored(inside.join(mixed.select("place"), "place"), "members")
    # A line has few places; a pair that shares several leaves the join at the first.
    known = left.groupBy("node").agg(F.collect_list("place").alias("places")).join(
        texts.select(F.col("line_id").alias("node"), "bag"), "node")
    left = left.join(known, "node")
    right = left.select("place", F.col("node").alias("other"), F.col("root").alias("other_root"),
                        F.col("bag").alias("other_bag"), F.col("places").alias("other_places"))
    apart = F.aggregate(F.zip_with("bag", "other_bag", lambda x, y: F.abs(x - y)), F.lit(0), lambda n, x: n + x)
    across = left.join(right, "place").where(
        F.expr("root < other_root") & (apart <= 2 * edits)
        & (F.array_min(F.array_intersect("places", "other_places")) == F.col("place")))
    across = across.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    rest = stored(across.join(first, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = stored(verified(rest), "links")
        if not more.isEmpty():
            roots = components(links.unionAll(more))
    return roots


def kept_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``_id, _key, kept, n_near``: positions of the lines that stay in each document, and
    how many first occurrences went because a near line stands earlier."""
    lines = exploded(docs)
    firsts = stored(lines.groupBy("line_id").agg(first_in_corpus()), "firsts")
    roots = line_links(lines, edits, min_chars)
    roots = bounded_broadcast(stored(roots, "roots"))
    named = firsts.join(roots, firsts["line_id"] == roots["node"])
    best = named.groupBy("root").agg(F.min("first").alias("best"))
    near = named.join(best, "root").where("first <> best").select("line_id", F.lit(True).alias("near"))
    near = bounded_broadcast(stored(near, "near"))
    found = firsts.join(near, "line_id", "left").select("first.*", F.coalesce("near", F.lit(False)).alias("near"))
    return found.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(
        F.array_sort(F.collect_list(F.when(~F.col("near"), F.col("pos")))).alias("kept"),
        F.count_if("near").alias("n_near"))


def deduplicated(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every document with only those lines that stand nowhere earlier in the corpus.

    docs: ``doc_id, text`` and any other columns. Returns the columns of docs, ``text``
    without the lines that went, and ``n_lines, n_kept, n_near``: lines that aren't
    blank, those that stayed, and first occurrences that went for a near line. Lines are
    compared without white space at their ends; those of at least ``min_chars``
    characters are also one if a chain of lines, each within ``edits`` edits of the next,
    connects them. The earliest line (smallest doc_id, a null as the smallest; then
    the hash of the text; then position) of each class stays. Blank lines stay.

    A null text stays null, an empty one empty, both with counts of 0. Repeated rows are
    one document: they lose the same lines. Documents that lose all lines keep their row.
    Texts and lines of any length are taken whole. Columns of docs called n_lines, n_kept
    or n_near, in any case, are replaced. An empty table gives an empty one.
    """
    kept = kept_lines(docs, edits, min_chars)
    text = docs["text"].cast("string")
    same = docs["doc_id"].cast("bigint").eqNullSafe(kept["_id"]) & (F.xxhash64(text) == kept["_key"])
    columns = [docs[f"`{c}`"] for c in docs.columns if c.lower() not in ("n_lines", "n_kept", "n_near")]
    joined = docs.join(kept, same, "left").select(
        F.struct(*columns).alias("_row"), F.split(text, "\n", -1).alias("_lines"),
        kept["kept"].alias("_kept"), kept["n_near"].alias("_near"))
    joined = joined.withColumn("_blank", F.filter(
        F.transform("_lines", lambda x, i: F.when(trimmed(x) == "", i)), lambda i: i.isNotNull()))
    none = F.array().cast("array<int>")
    stay = F.array_sort(F.concat(F.coalesce("_kept", none), F.coalesce("_blank", none)))
    stayed = F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n")
    result = joined.withColumn("_text", F.when(F.col("_lines").isNotNull(), stayed)).withColumn(
        "_row", F.col("_row").withField("text", F.col("_text")))
    return result.select(
        "_row.*",
        F.coalesce(F.size("_lines") - F.size("_blank"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("_kept"), F.lit(0)).cast("bigint").alias("n_kept"),
        F.coalesce("_near", F.lit(0)).cast("bigint").alias("n_near"))
