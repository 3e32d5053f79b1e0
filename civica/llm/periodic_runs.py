"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words with smallest period q and at least ``max(least, 2 * q)`` words
that can't be made longer at either end. For each power of two the dictionary names the
factors of that many words, equal ones alike; names of one length are pairs of names of half
that length, and a factor that stands once in its text needs none.

Periods from 2 * size on and below 4 * size are proposed by factors of ``size`` words. A run of
such a period holds an anchor, a multiple of ``size``, whose factor comes back one
period later. So the successors of each anchor's factor that are that far off propose
periods. Successors that lie at most half a factor apart form an arithmetic progression
whose difference is the factor's own period; a distance within one progression is a
multiple of that and proposes nothing new. Each proposal is made as long as it gets by
looking up factors of falling length, and equal stretches keep their smallest period.

Texts are handled where they are, many at a time; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.llm.hashing import pieces

LEAST = 12
CHUNK = 1 << 21

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class Factors:
    """The dictionary. ``levels[k]`` holds the name of the factor of 2**k words that begins
    at each word, -1 where it stands once in its text; ``listed[k]`` the places of the named
    ones and their names, by name, then place."""

    def __init__(self, words: np.ndarray, text: np.ndarray):
        """words: numbers from 0, equal for equal words; text: which one each stands in."""
        # Names differ between texts, so no factor that reaches over an end comes back.
        first = np.unique(text * (int(words.max()) + 1) + words, return_inverse=True)[1] if len(words) else words
        order = np.argsort(first, kind="stable")
        self.levels, self.listed = [first], [(order, first[order])]
        active, size = np.arange(len(words)), 1
        while True:
            names = self.levels[-1]
            active = active[active + size < len(words)]
            active = active[(names[active] >= 0) & (names[active + size] >= 0)]
            if not len(active):
                return
            pairs = names[active] * (int(names.max()) + 1) + names[active + size]
            order = np.argsort(pairs, kind="stable")
            new = np.flatnonzero(np.diff(pairs[order], prepend=-1))
            count = np.diff(new, append=len(order))
            again = np.repeat(count > 1, count)
            if not again.any():
                return
            number = np.repeat(np.arange(len(count)), count)[again]
            places = active[order[again]]
            level = np.full(len(words), -1, np.int64)
            level[places] = number
            self.levels.append(level)
            self.listed.append((places, number))
            active, size = np.sort(places), 2 * size

    def reach(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words are equal from a and from b on, or before them."""
        done = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            x, y = (a - done - (1 << k), b - done - (1 << k)) if back else (a + done, b + done)
            inside = np.flatnonzero(x >= 0 if back else y < len(self.levels[k]))
            left, right = self.levels[k][x[inside]], self.levels[k][y[inside]]
            done[inside[(left == right) & (left >= 0)]] += 1 << k
        return done

    def proposals(self, k: int, low: int, high: int, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances from ``low`` on and below ``high`` at which the factor of
        2**k words at a multiple of ``step`` comes back."""
        places, number = self.listed[k]
        gap = np.diff(places, append=0)
        close = np.append((number[1:] == number[:-1]) & (2 * gap[:-1] <= 1 << k), False)
        # The progression of each place, and where the next one begins.
        chain = np.cumsum(np.append(0, ~close[:-1]))
        ends = np.append(np.flatnonzero(~close) + 1, len(places))[chain]
        anchors = np.flatnonzero(places % step == 0)
        key = number * (len(self.levels[0]) + high + 1) + places
        begin = np.maximum(np.searchsorted(key, key[anchors] + low), ends[anchors])
        count = np.maximum(np.searchsorted(key, key[anchors] + high) - begin, 0)
        source = np.repeat(anchors, count)
        target = np.arange(len(source)) + np.repeat(begin - np.cumsum(count) + count, count)
        # A progression's own difference, once.
        inner = np.flatnonzero(close & np.append(True, ~close[:-1]) & (gap >= low) & (gap < high))
        return (np.concatenate([places[source], places[inner]]),
                np.concatenate([places[target] - places[source], gap[inner]]))


def runs_of(words: np.ndarray, text: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Start, length and period of every run of several texts, by start, then period."""
    factors = Factors(words, text)
    # Runs of ``least`` words have room for anchors half a factor apart up to this size,
    # which serve every period below twice the size.
    k = max(least // 3, 1).bit_length() - 1
    plans = [(k, 1, 2 << k, max(1 << k >> 1, 1))]
    plans += [(n, 2 << n, 4 << n, 1 << n) for n in range(k, len(factors.levels))]
    found = [np.empty((0, 3), np.int64)]
    for k, low, high, step in plans[: len(factors.levels) - k + 1] if k < len(factors.levels) else []:
        a, d = factors.proposals(k, low, high, step)
        start = a - factors.reach(a, a + d, back=True)
        length = a + d + factors.reach(a, a + d) - start
        fits = length >= np.maximum(least, 2 * d)
        found.append(np.stack([start, length, d], 1)[fits])
    rows = np.unique(np.concatenate(found), axis=0)
    # Of equal stretches the smallest period, which comes first.
    return rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1))[: len(rows)]]


def found_in(texts: pa.Array, least: int) -> list[pa.Array]:
    """Number of words, runs and collapsed text of each text."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.string()))
    flat, size = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # beside white space at an end
    text = np.repeat(np.arange(len(texts)), size)[filled]
    flat = flat.filter(pa.array(filled))
    count = np.bincount(text, minlength=len(texts))
    begin = np.cumsum(count) - count
    ids = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    start, length, period = runs_of(ids, text, least).T
    dropped = np.zeros(len(flat) + 1, np.int64)
    np.add.at(dropped, start + period, 1)
    np.add.at(dropped, start + length, -1)
    stays = np.cumsum(dropped)[:-1] == 0
    owner = text[start]
    by_text = np.lexsort((period, start))
    runs = pa.StructArray.from_arrays(
        [pa.array(x[by_text]) for x in (start - begin[owner], length, period)], names=["start", "length", "period"])
    offsets = np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts))))
    kept = np.append(0, np.cumsum(np.bincount(text[stays], minlength=len(texts))))
    words = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), flat.filter(pa.array(stays)))
    return [pa.array(count.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), runs),
            pc.binary_join(words, " ")]


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The runs of every text, and the text with each run collapsed to one period.

    docs: ``doc_id, text``. Returns ``doc_id, n_words, runs, collapsed``, a row for each row of
    docs. Words are what stands between ASCII white space, numbered from 0 and compared as they are.
    runs lists ``start, length, period`` by start, then period; a stretch is
    listed under its smallest period only, and runs may overlap. collapsed joins by single spaces the
    words that no run holds behind its first period.

    Null and empty texts have no words, no runs and an empty collapsed text. Repeated rows
    and ids, null ids included, give a row each. Texts are taken whole; one text's work
    arrays grow with its words times the logarithm of its longest repetition. Other
    columns are not read. An empty table gives no rows.
    """
    if least < 2:
        raise ValueError("a run has at least two words")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, 1, CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *found_in(batch.column(1), least)], names=["doc_id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string")
