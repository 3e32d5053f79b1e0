"""Word and shingle hashes of whole texts, vectorised over the bytes of an Arrow batch.

A word's hash is a polynomial in the codes of its bytes, taken as a difference of prefix
sums, so a batch costs a few passes over its bytes whatever the number of words. Work
arrays are bounded by ``CHUNK`` bytes of text; a longer text is cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base, and of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15 | 5
    up, down = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Alphabet:
    """Which bytes make words; A to Z count as a to z.

    Bytes from 0x80 on belong to characters beyond ASCII and are always word bytes.
    """

    def __init__(self, word_bytes: bytes):
        self.is_word = np.zeros(256, bool)
        self.is_word[list(word_bytes)] = True
        self.is_word[0x80:] = True
        folded = np.arange(256)
        folded[65:91] += 32
        self.codes = mix((folded.astype(np.uint64) + np.uint64(1)) * ODD)

    def hashes(self, data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and starts of the words of ``data`` (at most a chunk, unless a single
        word is longer); no word runs over a position in ``breaks``."""
        if not len(data):
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        word = self.is_word[data]
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        inner = breaks[(breaks > 0) & (breaks < len(data))]
        begins[inner] |= word[inner]
        ends[inner - 1] |= word[inner - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        size = CHUNK if len(data) <= CHUNK else 1 << int(len(data) - 1).bit_length()
        up, down = _powers(size)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * up[: len(data)], out=sums[1:])
        value = (sums[end] - sums[start]) * down[start]
        return mix(value + (end - start).astype(np.uint64) * ODD), start

    def words(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The word hashes of each text, in order; none for a null."""
        data, offsets = text_bytes(texts)
        first, n = 0, len(offsets) - 1
        while first < n:
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
            begin, end = int(offsets[first]), int(offsets[last])
            if end - begin > CHUNK:  # a single long text
                yield np.concatenate([self.hashes(p, np.empty(0, np.int64))[0]
                                      for p in self._pieces(data[begin:end])])
            else:
                bounds = offsets[first: last + 1] - begin
                found, start = self.hashes(data[begin:end], bounds)
                yield from np.split(found, np.searchsorted(start, bounds[1:-1]))
            first = last

    def _pieces(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """Cut a long text behind bytes that are in no word."""
        begin = 0
        while begin < len(data):
            end, reach = min(begin + CHUNK, len(data)), 0
            while end < len(data):
                gaps = np.flatnonzero(~self.is_word[data[begin + reach: end]])
                if len(gaps):
                    end = begin + reach + int(gaps[-1]) + 1
                    break
                reach, end = end - begin, min(end + CHUNK, len(data))
            yield data[begin:end]
            begin = end


#: Words between white space, and words of letters and digits.
SPACED = Alphabet(bytes(b for b in range(0x80) if b != 0x20 and not 0x09 <= b <= 0x0D))
ALNUM = Alphabet(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins (one more at the end)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    buffers = texts.buffers()
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.empty(0, np.uint8)
    return data, offsets


def pieces(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``size`` bytes of text, or a single longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, first = np.cumsum(sizes), 0
    while first < len(batch):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - sizes[first] + size, "right")))
        yield batch.slice(first, last - first)
        first = last


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words, in order; a shorter text has none."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    value = np.full(n, width, np.uint64)
    for k in range(width):
        value = value * ODD + words[k: k + n]
    return mix(value)


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct shingles; a text of fewer words counts as one shingle."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(shingles(words, min(width, len(words))))
