"""Chat formatting by quotation linking; DataFrame functions only.

Lines that begin with ``>`` marks are quotations, as deep as there are marks. Runs of
lines of one level are passages; they and their lines are normalised and hashed. So are
the paragraphs and lines that messages write themselves, and a hash leads to the first
message of the conversation that wrote it. A message replies to what its shallowest
quotation leads to; passages of a few words, which many messages may hold, decide only
where no longer one leads anywhere. Replies are followed to the message that began the
thread by doubling steps, and each message is formatted without its quotations and gets
its place in reply order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civica.llm.common import bounded_broadcast, stored

MARKS = r"^((?:[ \t]{0,3}>)+)"
# A line that only announces a quotation.
ANNOUNCES = r"(?i)^.{0,200}\b(wrote|schrieb|escribió|a écrit)\s*:\s*$"
MIN_WORDS = 3  # shorter passages link only where no longer one does
# Letters of scripts without spaces; each counts as a word.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"


def normalised(text: Column) -> Column:
    """Letters and digits in lower case, single spaces between."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parsed_lines(text: Column) -> Column:
    """``level, body`` of every line: the number of quotation marks, and the rest."""

    def line(raw: Column) -> Column:
        marks = F.regexp_extract(raw, MARKS, 1)
        level = F.length(F.regexp_replace(marks, "[^>]", ""))
        body = F.when(level > 0, F.trim(F.regexp_replace(raw, MARKS, ""))).otherwise(raw)
        return F.struct(level.alias("level"), body.alias("body"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), line)


def passages(lines: Column) -> Column:
    """``level, body`` of runs of filled lines of one level, and of each of the lines.

    Runs are marked by their first line; a line's run number counts those before it, so
    one pass over the lines numbers them and joins each run as it grows.
    """
    empty = F.array().cast("array<struct<level:int,body:string>>")

    def grow(state: Column, x: Column) -> Column:
        filled = F.trim(x["body"]) != ""
        same = filled & (state["level"] == x["level"])
        closed = F.when(state["level"] >= 0, F.concat(state["done"], F.array(
            F.struct(state["level"].alias("level"), F.array_join(state["open"], " ").alias("body"))))).otherwise(state["done"])
        return F.struct(
            F.when(same, state["done"]).otherwise(closed).alias("done"),
            F.when(filled, x["level"]).otherwise(F.lit(-1)).alias("level"),
            F.when(same, F.concat(state["open"], F.array(x["body"])))
             .otherwise(F.when(filled, F.array(x["body"])).otherwise(F.array().cast("array<string>"))).alias("open"))

    start = F.struct(empty.alias("done"), F.lit(-1).alias("level"), F.array().cast("array<string>").alias("open"))
    closing = F.array(F.struct(F.lit(0).alias("level"), F.lit("").alias("body")))
    runs = F.aggregate(F.concat(lines, closing), start, grow, lambda s: s["done"])
    single = F.filter(lines, lambda x: F.trim(x["body"]) != "")
    return F.concat(runs, single)


def hashed(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, level, passage, size, told`` of all that is not blank. size is the
    number of characters, told whether there are words enough to tell it from others.
    What holds no letter or digit is taken as it stands."""
    found = rows.select("conv_id", "turn", F.explode(F.array_distinct(passages(F.col("lines")))).alias("x"))
    found = found.select("conv_id", "turn", F.col("x.level").alias("level"), F.col("x.body").alias("body"),
                         normalised(F.col("x.body")).alias("text"))
    bare = F.trim(F.regexp_replace("body", r"\s+", " "))
    found = found.withColumn("text", F.when(F.col("text") != "", F.col("text")).otherwise(bare)).where("text <> ''")
    words = F.size(F.split(F.trim(F.regexp_replace("text", f"({UNSPACED})", " $1 ")), " +"))
    return found.select("conv_id", "turn", "level", F.xxhash64("text").alias("passage"),
                        F.length("text").alias("size"), (words >= MIN_WORDS).alias("told"))


def reply_links(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, parent``: the earlier message that a message quotes.

    rows: ``conv_id, turn, lines``. Only conversations with a quotation are searched for
    originals.
    """
    known = rows.where("conv_id is not null and turn is not null")
    quoting = known.where(F.exists("lines", lambda x: x["level"] > 0))
    quoted = stored(hashed(quoting).where("level > 0").groupBy("conv_id", "turn", "passage").agg(
        F.min("level").alias("level"), F.max("size").alias("size"), F.max("told").alias("told")), "quoted")
    talks = bounded_broadcast(stored(quoted.select("conv_id").distinct(), "talks"))
    own = hashed(known.join(talks, "conv_id", "left_semi")).where("level = 0")
    originals = own.groupBy("conv_id", "passage").agg(F.min("turn").alias("parent"))
    met = quoted.join(originals, ["conv_id", "passage"]).where("parent < turn")
    # The shallowest quotation counts, of one level the longest; of several originals the
    # latest. Whatever is told apart comes before what is not.
    place = F.struct("told", (-F.col("level")).alias("near"), F.when(F.col("told"), 0).otherwise(F.col("size")).alias("size"), "parent")
    best = met.groupBy("conv_id", "turn").agg(F.max(place).alias("best"))
    return best.select("conv_id", "turn", F.col("best.parent").alias("parent"))


def threads(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``conv_id, turn, parent, root, depth`` of stored links; a step doubles what is known."""
    current = links.select("conv_id", "turn", "parent", F.col("parent").alias("root"), F.lit(1).alias("depth"))
    current = stored(current, "threads")
    while True:
        above = current.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("next"), F.col("depth").alias("more"))
        moved = current.join(above, ["conv_id", "root"], "left")
        if moved.where("next is not null").isEmpty():
            return current
        current = stored(moved.select(
            "conv_id", "turn", "parent", F.coalesce("next", "root").alias("root"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "threads")


def reply_places(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, place`` of ``conv_id, root, turn``: the number of the turn, from 0, in
    its conversation by root and turn. Numbered within ranges of the whole order, so a
    conversation of any length is spread, and moved by the ranges before."""
    ranged = turns.repartitionByRange("conv_id", "root", "turn")
    ranged = stored(ranged.withColumn("part", F.spark_partition_id()), "turns")
    parts = ranged.groupBy("conv_id", "part").count()
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A range has one conversation at most that began in an earlier one.
    begun = parts.select("conv_id", "part", F.sum("count").over(before).alias("begun")).where("begun is not null")
    inside = F.row_number().over(Window.partitionBy("part", "conv_id").orderBy("root", "turn"))
    numbered = ranged.select("conv_id", "part", "turn", (inside - 1).cast("bigint").alias("inside"))
    return numbered.join(F.broadcast(begun), ["conv_id", "part"], "left").select(
        "conv_id", "turn", (F.col("inside") + F.coalesce("begun", F.lit(0))).alias("place"))


def formatted(conversations: DataFrame) -> DataFrame:
    """Every message with its thread, in chat form without quotations.

    conversations: ``conv_id, turn, role, text``. Returns ``conv_id, turn, role, parent,
    root, depth, place, text, chat``, a row for each row. parent is the turn replied to (null
    for none), root the turn that began the thread (the own one without a parent) and
    depth the number of replies between. place numbers the turns of a conversation from 0
    by root and turn: reply order, as a reply always comes after what it replies to and
    threads stay together. Rows are not collected, so a conversation of any length stays
    spread; its chat texts joined by place are the conversation. text is what the message writes itself: no quotations, no line that announces one,
    no blank lines at its ends.

    A null text is empty, a null role 'unknown'. Rows with a null conv_id or turn are kept
    and linked with nothing, their place is null. Repeated rows are all kept; several
    messages of one turn share its parent and place. A quotation of one or two words, or
    of no letters at all, links only where the message quotes no longer passage that is
    known, even a deeper one. Quotations of nothing known are removed and link nothing. Messages
    of any length are read whole. Other columns are not read.
    """
    spark = conversations.sparkSession
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        parsed_lines(F.col("text").cast("string")).alias("lines"))
    links = stored(reply_links(rows), "links")
    placed = bounded_broadcast(threads(spark, links).select(
        F.col("conv_id").alias("_conv"), F.col("turn").alias("_turn"), "parent", "root", "depth"))
    known = rows.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    turns = known.join(placed, (known["conv_id"] == placed["_conv"]) & (known["turn"] == placed["_turn"]), "left")
    places = stored(reply_places(turns.select("conv_id", F.coalesce("root", "turn").alias("root"), "turn")), "places")
    places = bounded_broadcast(places.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "place"))
    rows = rows.join(places, (rows["conv_id"] == places["_c"]) & (rows["turn"] == places["_t"]), "left")
    joined = rows.join(placed, (rows["conv_id"] == placed["_conv"]) & (rows["turn"] == placed["_turn"]), "left")
    quotes_next = lambda i: F.coalesce(F.get("lines", i + 1)["level"] > 0, F.lit(False))
    own = F.filter("lines", lambda x, i: (x["level"] == 0) & ~(x["body"].rlike(ANNOUNCES) & quotes_next(i)))
    body = F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), r"^\s+|\s+$", "")
    result = joined.withColumn("text", body)
    return result.select(
        "conv_id", "turn", "role", "parent", F.coalesce("root", "turn").alias("root"),
        F.coalesce("depth", F.lit(0)).alias("depth"), "place", "text",
        F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")).alias("chat"))
