"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are short and documents long, so what counts is the share of an item's
five-word shingles that a document holds. Items are partitioned by their number of
shingles; a partition of at most ``u`` keeps, of every item, the ``u - ceil(t * u) + 1``
smallest shingle hashes (its MinHash sketch). A document that holds the share ``t`` of
an item lacks too few shingles to miss the whole sketch, so looking up all of a
document's shingles in the sketches finds every pair. Each pair found is then verified
on the exact shingle words of item and document. An item of fewer than five words is one
shingle, its whole sequence, which a document must hold as it is.

Documents are only mapped, never shuffled. Items go to the tasks in blocks, bounded in
number and bytes, one pass over the documents for each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civica.llm.common import stored
from civica.llm.hashing import ALNUM, mix, shingle_set, shingles

WIDTH = 5
THRESHOLD = 0.8
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32 * 1024 * 1024
WORD = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}
FOUND = "doc_id bigint, item_id bigint, n_shared bigint, n_item bigint, containment double"


def needed(n: int, threshold: float) -> int:
    """How many of ``n`` shingles make the share ``threshold``."""
    return math.ceil(round(n * threshold, 9))


def partition_limit(n: int) -> int:
    """The largest size of the partition that ``n`` falls into; limits grow by a quarter."""
    limit = 1
    while limit < n:
        limit = max(limit + 1, limit * 5 // 4)
    return limit


def shingle_words(text: str, width: int) -> set[tuple[str, ...]]:
    words = WORD.findall(text.translate(UPPER_TO_LOWER))
    return {tuple(words[i: i + width]) for i in range(len(words) - width + 1)}


class ItemIndex:
    """The sketches of a block of items as one sorted array of hashes."""

    def __init__(self, items: list[tuple[int, str]], threshold: float, width: int):
        self.threshold = threshold
        sets = [(shingle_set(words, width), min(width, len(words)))
                for words in ALNUM.words(pa.array([text for _, text in items], pa.string()))]
        # Items of the same words share one entry.
        self.items, place = [], {}
        for (item, text), (found, size) in zip(items, sets):
            if len(found):
                key = found.tobytes()
                if key not in place:
                    place[key] = len(self.items)
                    self.items.append((text, found, [], size))
                self.items[place[key]][2].append(item)
        hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        self.widths = sorted({size for *_, size in self.items})
        for k, (_, found, _, _) in enumerate(self.items):
            limit = partition_limit(len(found))
            size = limit - needed(limit, threshold) + 1
            sketch = np.sort(mix(found))[:size]
            hashes.append(sketch)
            owners.append(np.full(len(sketch), k))
        hashes, owners = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owners = hashes[order], owners[order]
        self.flags = np.zeros(1 << 16, bool)
        self.flags[self.hashes & np.uint64(0xFFFF)] = True

    def search(self, words: np.ndarray, text: pa.StringScalar) -> Iterator[tuple[list[int], int, int]]:
        """Item ids, shared and all shingles for the items that the text contains."""
        own = np.concatenate([shingles(words, width) for width in self.widths])
        probe = mix(own)
        probe = probe[self.flags[probe & np.uint64(0xFFFF)]]
        low = np.searchsorted(self.hashes, probe, "left")
        high = np.searchsorted(self.hashes, probe, "right")
        hit = high > low
        if not hit.any():
            return
        owners = np.unique(np.concatenate(
            [self.owners[a:b] for a, b in set(zip(low[hit].tolist(), high[hit].tolist()))]))
        distinct, held = np.unique(own), {}
        for k in owners.tolist():
            item_text, found, ids, width = self.items[k]
            at = np.minimum(np.searchsorted(distinct, found), len(distinct) - 1)
            if int((distinct[at] == found).sum()) < needed(len(found), self.threshold):
                continue
            if width not in held:
                held[width] = shingle_words(text.as_py(), width)
            wanted = shingle_words(item_text, width)
            shared = len(wanted & held[width])
            if shared >= needed(len(wanted), self.threshold):
                yield ids, shared, len(wanted)


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                    width: int = WIDTH, block_items: int = BLOCK_ITEMS,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Pairs of documents and the benchmark items they contain.

    docs: ``doc_id, text``; items: ``item_id, text``. Returns ``doc_id, item_id, n_shared,
    n_item, containment`` for every pair whose share of the item's distinct ``width``-word
    shingles is at least ``threshold``. Words are runs of ASCII letters and digits and of
    characters beyond ASCII; A to Z count as a to z, so case and punctuation don't matter.

    Nulls: a null text has no words; a null id is returned as null. An item of fewer than
    ``width`` words is one shingle: documents match that hold its words in a row, documents
    of fewer than ``width`` words among them. Items without words match nothing, and
    documents without words contain nothing. Repeated rows of documents give repeated rows; repeated items count once. Other columns are
    not read. Texts of any length are searched whole.
    """
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null").distinct()
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n_blocks = max(1, math.ceil(count / block_items), math.ceil(size / block_bytes))
    if n_blocks > 1:
        items = stored(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))), "items")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def searched(block: list[tuple[int, str]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(ItemIndex(block, threshold, width))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                found = []
                for i, words in enumerate(ALNUM.words(batch.column(1))):
                    if not index.widths or len(words) < index.widths[0]:
                        continue
                    hits = index.search(words, batch.column(1)[i])
                    for ids, n, of in hits:
                        found += [(batch.column(0)[i].as_py(), item, n, of, n / of) for item in ids]
                columns = zip(*found) if found else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.float64() if k == 4 else pa.int64()) for k, c in enumerate(columns)],
                    names=["doc_id", "item_id", "n_shared", "n_item", "containment"])

        return docs.mapInArrow(search, FOUND)

    result = None
    for k in range(n_blocks):
        block = items.where(F.col("block") == k).select("item_id", "text") if n_blocks > 1 else items
        part = searched([(row[0], row[1]) for row in block.collect()])
        result = part if result is None else result.unionAll(part)
    return result


def decontaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that contain no item, with all their columns.

    A document is taken by its doc_id and text; one with a null id is judged by its text
    as well. Repeated rows stay or go together. Without items all documents stay; an empty
    table gives an empty one.
    """
    key = F.xxhash64(docs["text"], docs["text"].isNull())
    judged = docs.select(key.alias("doc_id"), "text")
    hits = stored(contained_items(judged, items, **options).select("doc_id").distinct(), "leaks")
    return docs.join(hits, key == hits["doc_id"], "left_anti")
