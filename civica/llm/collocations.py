"""Phrase collocation mining by Toivonen's method.

1. A sample of the documents, drawn by a hash of each, proposes phrases: those of up to
   ``longest`` words that come up often enough there at a lowered threshold.
2. A full pass counts the proposed phrases exactly, and with them the negative border: the
   phrases that were not proposed though all their parts were (any word is one; a longer phrase is, if
   its first and its last part are proposed).
3. Border phrases that turn out frequent are failures of the sample. What the pass missed
   holds one of them and consists of frequent words, which are known by now. So the expansion
   pass counts the phrases of this kind that were not counted yet, of every size at once,
   and that closes the result.

Passes know sets of phrases by filters of ``FILTER_BITS`` bits, the only thing that is sent to
all tasks. A phrase that a filter takes for one of its own is counted, which costs time and
changes nothing; so a corpus with more phrases than a filter has bits for is still
counted exactly. Within a batch, phrases are numbers (pairs of numbers of shorter ones),
and each distinct one leaves the batch once, as text with its count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civica.llm.common import LOWER, UPPER, stored
from civica.llm.hashing import ODD, mix, pieces

SEPARATORS = ".,;:!?\n\x0b\f\r"
NO_LANG = "und"
LEAST = 30
LONGEST = 4
SAMPLE = 16  # one document of so many
FILTER_BITS = 1 << 25
CHUNK = 1 << 21
ROWS = 100_000
CUT = 2_000_000
COVERED = 80
TOP = 2_000

# Every separator becomes a full stop with spaces around it: a word of its own that ends a piece.
TABLE = bytes.maketrans((UPPER + SEPARATORS + "\t").encode(), (LOWER + "." * len(SEPARATORS) + " ").encode())

def hash_of(word: bytes, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def longer(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases, from those of the phrases without the last word and of that word."""
    return mix(left * ODD + word)


def bit_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes % np.uint64(len(bits) * 64)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


@dataclass
class Filters:
    """What a pass knows: nothing in the sample, the proposals in the full pass, in the
    expansion also the frequent words and the failures."""

    proposed: np.ndarray | None = None
    words: np.ndarray | None = None
    failures: np.ndarray | None = None


class Batch:
    """Texts of one language as numbers of words, 0 where a piece ends."""

    def __init__(self, lang: str, texts: list[str]):
        data = ". " + b" . ".join(x.encode() for x in texts).translate(TABLE).replace(b".", b" . ").decode()
        tokens = pc.ascii_split_whitespace(pa.array([data], pa.large_string())).flatten()
        coded = tokens.filter(pc.not_equal(tokens, "")).dictionary_encode()
        self.words = coded.dictionary.cast(pa.string())
        self.ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        own = [hash_of(x) for x in coded.dictionary.cast(pa.large_binary()).to_pylist()]
        self.hashes = np.array(own, np.uint64)[self.ids]
        self.first = longer(np.uint64([hash_of(lang.encode(), 1)]), self.hashes)

    def counted(self, longest: int, filters: Filters) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Size, places and counts of the phrases that a pass with these filters counts; a
        place stands for the phrase that begins there."""
        ids, names, value = self.ids, self.ids, self.first
        at = np.flatnonzero(ids)
        # Where a phrase begins that the first full pass counts, and one that holds a failure.
        taken, holds = ids > 0, np.zeros(len(ids), bool)
        if filters.failures is not None:
            at = at[bit_set(filters.words, value[at])]
            usable = np.zeros(len(ids), bool)
            usable[at] = True
        for size in range(1, longest + 1):
            if size > 1:
                at = at[at + size <= len(ids)]
                at = at[ids[at + size - 1] > 0]
                if filters.failures is not None:
                    at = at[usable[at + size - 1]]
                    holds[at] |= holds[at + 1]
                if filters.proposed is not None:
                    held, taken = taken & bit_set(filters.proposed, value), np.zeros(len(ids), bool)
                    taken[at] = held[at] & held[at + 1]
                    if filters.failures is None:
                        at = at[taken[at]]
                value, parts = np.zeros(len(ids), np.uint64), value
                value[at] = longer(parts[at], self.hashes[at + size - 1])
            if filters.failures is not None:
                new = at[holds[at] & ~taken[at]]
                _, first, count = np.unique(self.numbers(new, size), return_index=True, return_counts=True)
                yield size, new[first], count
                holds[at] |= bit_set(filters.failures, value[at])
            elif size == 1:  # numbers of words rise where a word stands first
                yield size, np.flatnonzero(np.diff(np.maximum.accumulate(ids), prepend=0)), np.bincount(ids)[1:]
            else:
                pairs = names[at] * len(self.words) + ids[at + size - 1]
                _, first, number, count = np.unique(pairs, return_index=True, return_inverse=True, return_counts=True)
                names = np.zeros(len(ids), np.int64)
                names[at] = number
                yield size, at[first], count

    def numbers(self, at: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the phrases of ``size`` words that begin at the given places."""
        found = self.ids[at]
        for k in range(1, size):
            found = np.unique(found * len(self.words) + self.ids[at + k], return_inverse=True)[1]
        return found

    def texts(self, at: np.ndarray, size: int) -> pa.Array:
        return pc.binary_join_element_wise(*[self.words.take(pa.array(self.ids[at + k])) for k in range(size)], " ")


def slices(batch: pa.RecordBatch) -> Iterator[tuple[str, list[str]]]:
    """The texts of each language, in lists of at most about ``CHUNK`` bytes or a single text."""
    for piece in pieces(batch, 1, CHUNK):
        for lang in piece.column(0).unique().to_pylist():
            yield lang, piece.column(1).filter(pc.equal(piece.column(0), lang)).to_pylist()


def counted(docs: DataFrame, longest: int, filters: Filters) -> DataFrame:
    """``key, n``: exact counts over docs of the phrases of a pass; a key is a phrase, a line
    end and a language. docs: ``lang, text``, without nulls. The first full pass also gives
    the number of words of each language, as the empty phrase."""
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def rows(phrases: pa.Array, lang: str, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        keys = pc.binary_join_element_wise(phrases, lang, "\n")
        whole = pa.RecordBatch.from_arrays([keys, pa.array(n, pa.int64())], names=["key", "n"])
        for at in range(0, len(whole), ROWS):
            yield whole.slice(at, ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for lang, texts in slices(batch):
                words = Batch(lang, texts)
                if known.proposed is not None and known.failures is None:
                    yield from rows(pa.array([""]), lang, np.array([np.count_nonzero(words.ids)]))
                for size, at, n in words.counted(longest, known):
                    if len(at):
                        yield from rows(words.texts(at, size), lang, n)
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, "key string, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def named(found: DataFrame) -> DataFrame:
    """``lang, phrase, size, n`` of counts by key; the empty phrase has the size 0."""
    rows = found.withColumn("phrase", F.substring_index("key", "\n", 1))
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return rows.select(F.substring("key", F.length("phrase") + 2, F.length("key")).alias("lang"), "phrase",
                       words.alias("size"), "n")


def hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    """The hashes that a batch gives phrases."""
    seeds = {lang: hash_of(lang.encode(), 1) for lang in set(langs)}
    value = np.array([seeds[lang] for lang in langs], np.uint64)
    split = [phrase.encode().split(b" ") for phrase in phrases]
    for k in range(max(map(len, split), default=0)):
        rows = [i for i, x in enumerate(split) if len(x) > k]
        value[rows] = longer(value[rows], np.array([hash_of(split[i][k]) for i in rows], np.uint64))
    return value


def filter_of(phrases: DataFrame, bits: int) -> np.ndarray:
    """The filter of the given ``lang, phrase``. Tasks set bits; the driver gets the words
    of the filter that have any, of which there are at most ``bits / 64``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(hashes(*(x.to_pylist() for x in batch.columns)) % np.uint64(bits))
            yield pa.RecordBatch.from_arrays(
                [pa.array((at >> np.uint64(6)).astype(np.int64)),
                 pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["at", "bits"])

    found = phrases.select("lang", "phrase").mapInArrow(run, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    table = found.toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[table.column("at").to_numpy()] = table.column("bits").to_numpy().view(np.uint64)
    return out


def outside(phrases: DataFrame, bits: np.ndarray) -> DataFrame:
    """``lang, phrase`` of the given ones that a filter doesn't hold."""
    sent = phrases.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~bit_set(sent.value, hashes(*(x.to_pylist() for x in batch.columns)))))

    return phrases.select("lang", "phrase").mapInArrow(run, "lang string, phrase string")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, sample: int = SAMPLE,
                     bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame, int]:
    """``lang, phrase, size, n`` of every phrase of up to ``longest`` words that stands in
    docs at least ``least`` times; ``lang, n``, the words of each language; and how many full
    passes that took.

    docs: ``doc_id, lang, text``. The sample holds about one document of ``sample``. Its
    threshold is lowered to what a phrase of ``least`` places reaches there with some certainty.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       F.xxhash64("doc_id", "text").alias("key"))
    drawn, rows = rows.where(F.pmod(F.col("key"), F.lit(sample)) == 0).drop("key"), rows.drop("key")
    expected = least / sample
    lowered = max(2, int(expected - 1.3 * expected ** 0.5))
    proposed = filter_of(named(counted(drawn, longest, Filters()).where(F.col("n") >= lowered)), bits)
    found = counted(rows, longest, Filters(proposed))
    found = stored(named(found.where((F.col("n") >= least) | F.startswith("key", F.lit("\n")))), "phrases")
    totals, whole, passes = found.where("size = 0").select("lang", "n"), found.where("size > 0"), 1
    failures = stored(outside(whole.where(F.col("size") < longest), proposed), "failures")
    if not failures.isEmpty():
        filters = Filters(proposed, filter_of(whole.where("size = 1"), bits), filter_of(failures, bits))
        more = named(counted(rows, longest, filters).where(F.col("n") >= least))
        whole, passes = whole.unionAll(stored(more, "phrases")), 2
    return whole, totals, passes


def wide(x: str) -> Column:
    return F.col(x).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED,
                 sample: int = SAMPLE, bits: int = FILTER_BITS) -> DataFrame:
    """Every phrase of two to ``longest`` words with its cohesion.

    docs: ``doc_id, lang, text``. Returns ``lang, phrase, a, l, r, n, score``, in no order. A to Z count
    as lower case; separators (``.,;:!?`` and line ends) part pieces, spaces and tabs part
    words, and phrases stay within a piece. a counts all places of a phrase, overlaps included; those of
    at least ``least`` places are returned. Cut after its first k words, the parts
    have l and r places and the score is ``floor(2000000 * a / (l + r))``, the least over k; of equal
    ones the smallest k counts. A phrase goes if it stands in a longer one with at least
    ``covered`` per cent of its places. n is the number of words of the language.

    A null lang is ``und``; null and empty texts have no words. Repeated rows count each
    time. Texts are taken whole. Other columns are not read. An empty table gives no rows. Counts and
    products are exact.
    """
    found, totals, _ = frequent_phrases(docs, least, longest, sample, bits)
    words = F.split("phrase", " ")
    candidates = found.where(F.col("size") >= 2)
    counts = found.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_phrase"), F.col("n").alias("_n"))

    def part(begin: Column | int, size: Column) -> Column:
        return F.array_join(F.slice(words, begin, size), " ")

    def places_of(rows: DataFrame, phrase: str, out: str) -> DataFrame:
        same = (F.col("lang") == F.col("_lang")) & (F.col(phrase) == F.col("_phrase"))
        return rows.join(counts, same).withColumnRenamed("_n", out).drop("_lang", "_phrase")

    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("n").alias("a"), "k", part(1, F.col("k")).alias("head"),
                       part(F.col("k") + 1, F.col("size") - F.col("k")).alias("tail"))
    cuts = places_of(places_of(cuts, "head", "l"), "tail", "r")
    # The quotient is at most half of CUT, as a part has no fewer places than the whole.
    score = F.expr(f"(cast(a as decimal(20,0)) * {CUT}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))

    inner = candidates.where(F.col("size") >= 3).select("lang", "phrase", "size", F.col("n").alias("m"), F.explode(
        F.sequence(F.lit(2), F.col("size") - 1)).alias("width"))
    inner = inner.withColumn("begin", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("width") + 1)))
    inner = inner.select(F.col("lang").alias("_lang"), part(F.col("begin"), F.col("width")).alias("_phrase"), "m")
    inner = inner.groupBy("_lang", "_phrase").agg(F.max("m").alias("m"))
    same = (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_phrase"))
    shadowed = (wide("m") * 100 >= F.col("cut.a").cast("decimal(20,0)") * covered)
    kept = best.join(inner, same, "left").where(F.coalesce(~shadowed, F.lit(True)))
    rows = kept.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")
    totals = totals.select(F.col("lang").alias("_lang"), "n")
    return rows.join(totals, F.col("lang") == F.col("_lang")).select("lang", "phrase", "a", "l", "r", "n", "score")


def top_collocations(docs: DataFrame, top: int = TOP, **options: int) -> DataFrame:
    """The first ``top`` collocations of each language with their ``rank``: by score, then a, both
    falling, then phrase in the order of its bytes. Tasks keep their own best ones, so a
    language's rows don't meet before."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = collocations(docs, **options).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
