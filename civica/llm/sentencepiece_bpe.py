"""SentencePiece encoding and decoding with seeded merge dropout.

Text is cut into units: a run of spaces, then what is no letter, then letters. No piece
of the model reaches over such a cut (checked on loading), so units are encoded on their
own. A unit's
characters are merged by an agenda: the best scored adjacent pair first, the leftmost of
equals; a popped candidate is skipped if its bit is set, and never offered again as that
pair. Each bit is a keyed hash of seed, text, the unit's position and the candidate's
ordinal, so every candidate is skipped on its own, and a lost task that runs again gives
the same pieces.

Units are encoded where their document is, those of some texts at a time: the distinct ones once
without dropout, which also tells how many candidates each takes, and then, with their own
bits, those that have one of these candidates skipped. Agendas of units of like length
run side by side in arrays, a candidate of each at every step. Nothing is kept from batch to batch
but the model, and nothing is shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece.sentencepiece_model_pb2 import ModelProto

from civica.llm.hashing import ODD, mix, pieces as slices

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 13
LANES = 16  # candidates whose bits are drawn for all units of a text at once
CHUNK = 1 << 20
LENGTHS = (2, 4, 6, 8, 12, 16, 24, 32, 64)  # agendas that run side by side hold up to so many characters
LONG_UNIT = 64
NO_PIECE = 1 << 60

Skip = Callable[[np.ndarray, int], np.ndarray]


def drawn(keys: np.ndarray, count: int, bar: int) -> np.ndarray:
    """The skip bits of the first candidates of each unit, at least ``count``, packed to
    bytes with the first candidate lowest. A hash serves two candidates with 32 bits each;
    those below ``bar`` are skipped."""
    ordinals = np.arange((count + 15) // 16 * 8, dtype=np.uint64) * ODD
    return np.packbits(mix(keys[:, None] + ordinals).view("<u4") < bar, axis=1, bitorder="little")


def skipped(keys: np.ndarray, ordinal: int, bar: int) -> np.ndarray:
    """The same bits for one candidate of each unit."""
    value = mix(keys + np.uint64(ordinal // 2 * int(ODD) % (1 << 64)))
    return (value >> np.uint64(32 * (ordinal % 2)) & np.uint64(0xFFFFFFFF)) < np.uint64(bar)


class PairTable:
    """Which adjacent symbols make a piece, as an open-addressing table over numbers."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        self.mask = (1 << max(4, int(len(left) * 8).bit_length())) - 1
        self.keys = np.full(self.mask + 1, -1, np.int64)
        self.joined = np.full(self.mask + 1, -1, np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        self.probes, rest, at = 0, np.arange(len(key)), self._slot(key)
        while len(rest):
            free = rest[self.keys[at[rest]] < 0]
            self.keys[at[free]] = key[free]  # of several the last one stays
            won = self.keys[at[rest]] == key[rest]
            self.joined[at[rest[won]]] = joined[rest[won]]
            rest = rest[~won]
            at[rest] = at[rest] + 1 & self.mask
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * ODD >> np.uint64(40)).astype(np.int64) & self.mask

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or -1."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._slot(key)
        out = np.where(self.keys[at] == key, self.joined[at], -1)
        rest = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(rest):
                break
            at[rest] = at[rest] + 1 & self.mask
            hit = self.keys[at[rest]] == key[rest]
            out[rest[hit]] = self.joined[at[rest[hit]]]
            rest = rest[~hit & (self.keys[at[rest]] >= 0)]
        return out


class Pieces:
    """The model's pieces, and encoding of units with them."""

    def __init__(self, model_path: str):
        own = ModelProto.FromString(Path(model_path).read_bytes())
        own.normalizer_spec.add_dummy_prefix = False  # units bring their spaces along
        self.library = sentencepiece.SentencePieceProcessor(model_proto=own.SerializeToString())
        model = self.library
        size = model.get_piece_size()
        self.bytes, self.text_of, self.id_of = [0] * 256, [b""] * size, {}
        for k in range(size):
            piece = model.id_to_piece(k)
            if model.is_byte(k):
                self.bytes[int(piece[3:5], 16)] = k
                self.text_of[k] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
                self.id_of[piece] = k
                self.text_of[k] = piece.replace(SPACE, " ").encode()
        if not all(UNITS.fullmatch(piece.replace(SPACE, " ")) for piece in self.id_of):
            raise ValueError("a piece of this model reaches over the end of a unit")
        # The place of each piece's score, the best first; equal scores share it.
        score = {piece: model.get_score(k) for piece, k in self.id_of.items()}
        place = {x: n for n, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {piece: place[x] for piece, x in score.items()}
        self.size = size
        self.rank_of = np.zeros(size, np.int32)
        self.rank_of[list(self.id_of.values())] = list(self.rank.values())
        # Characters as symbols: their pieces, or from ``size`` on what goes as one byte.
        self.symbol_of, self.output = np.full(0x110000, -1, np.int32), np.arange(size + 128, dtype=np.int32)
        self.symbol_of[:128] = size + np.arange(128)
        self.output[size:] = self.bytes[:128]
        for c in {c for piece in self.id_of for c in piece}:
            if c in self.id_of:
                self.symbol_of[ord(c)] = self.id_of[c]
        number = {c: k for piece in self.id_of for c in piece if (k := int(self.symbol_of[ord(c)])) >= 0} | self.id_of
        self.symbol_of[ord(" ")] = self.symbol_of[ord(SPACE)]
        # A literal sign of a space goes byte by byte, so that it comes back as such.
        self.symbol_of[ord(SPACE)] = -1
        splits = [(number[piece[:k]], number[piece[k:]], found) for piece, found in self.id_of.items()
                  for k in range(1, len(piece)) if piece[:k] in number and piece[k:] in number]
        self.pairs = PairTable(*np.array(splits, np.int64).reshape(-1, 3).T)

    def ids(self, symbols: list[str]) -> tuple[int, ...]:
        known = self.id_of.get
        out = [known(symbol) for symbol in symbols]
        if None in out:
            out = [k for symbol, found in zip(symbols, out)
                   for k in ([found] if found is not None else [self.bytes[b] for b in symbol.encode()])]
        return tuple(out)

    def merge(self, unit: str, skips: int) -> tuple[tuple[int, ...], int]:
        """Ids of a unit, and how many candidates its agenda took; bit j of ``skips`` is
        set if the j-th is skipped."""
        if len(unit) > LONG_UNIT:
            return self._merge_long(unit, skips)
        rank, symbols = self.rank.get, list(unit)
        # The rank of every adjacent pair; a skipped pair has none from then on.
        pairs = [rank(a + b, NO_PIECE) for a, b in zip(symbols, symbols[1:])]
        taken, last = 0, len(pairs) - 1
        while pairs and (best := min(pairs)) < NO_PIECE:
            at = pairs.index(best)
            skipped = skips and skips >> taken & 1
            taken += 1
            if skipped:
                pairs[at] = NO_PIECE
                continue
            joined = symbols[at] + symbols.pop(at + 1)
            symbols[at] = joined
            del pairs[at]
            last -= 1
            if at <= last:
                pairs[at] = rank(joined + symbols[at + 1], NO_PIECE)
            if at:
                pairs[at - 1] = rank(symbols[at - 1] + joined, NO_PIECE)
        return self.ids(symbols), taken

    def _merge_long(self, unit: str, skips: int) -> tuple[tuple[int, ...], int]:
        """The same with a heap, for units of many characters."""
        rank, symbols = self.rank, list(unit)
        n = len(symbols)
        flags = skips.to_bytes(max(3 * n, skips.bit_length()) // 8 + 1, "little")
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found, i, symbols[i], symbols[i + 1]) for i in range(n - 1)
                if (found := rank.get(symbols[i] + symbols[i + 1])) is not None]
        heapq.heapify(heap)
        taken = 0
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            skipped = flags[taken >> 3] >> (taken & 7) & 1
            taken += 1
            if skipped:
                continue
            symbols[i], symbols[j] = left + right, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (found := rank.get(symbols[a] + symbols[b])) is not None:
                    heapq.heappush(heap, (found, a, symbols[a], symbols[b]))
        return self.ids([s for s in symbols if s]), taken

    def merge_many(self, symbols: np.ndarray, length: np.ndarray, skip: Skip | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of many units, one after the other, how many each has, and how many
        candidates its agenda took. Columns of ``symbols`` are units of ``length`` characters; skip
        tells which of the given units skip the candidate of an ordinal."""
        height, width = symbols.shape
        bits = max(1, int(height - 1).bit_length())
        low, none = (1 << bits) - 1, np.iinfo(np.int32).max
        ids, looked = np.full((height, width), -1, np.int32), np.zeros(width, np.int64)
        own = np.arange(width)
        place = np.arange(height, dtype=np.int8)[:, None]
        after, before = np.repeat(place + 1, width, 1), np.repeat(place - 1, width, 1)
        best, made = np.full((height, width), none, np.int32), np.full((height, width), -1, np.int32)

        def offer(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> None:
            found = self.pairs.find(symbols[x, c], symbols[y, c])
            made[x, c] = found
            best[x, c] = np.where(found >= 0, self.rank_of[found] << bits | x, none)

        for x in range(height - 1):
            c = np.flatnonzero(length > x + 1)
            offer(np.full(len(c), x), np.full(len(c), x + 1), c)
        for ordinal in range(3 * height):
            top = best.min(axis=0)
            c = np.flatnonzero(top < none)
            if 3 * len(c) < 2 * len(own):  # agendas that are done leave
                done = top == none
                ids[:, own[done]] = symbols[:, done]
                own, length, top = own[c], length[c], top[c]
                symbols, after, before, best, made = (x[:, c] for x in (symbols, after, before, best, made))
                c = np.arange(len(own))
            if not len(c):
                break
            x = top[c] & low
            looked[own[c]] += 1
            if skip is not None:
                gone = skip(own[c], ordinal)
                best[x[gone], c[gone]] = none
                x, c = x[~gone], c[~gone]
            y = after[x, c]
            symbols[x, c] = made[x, c]
            symbols[y, c], best[y, c], best[x, c] = -1, none, none
            z = after[y, c]
            after[x, c] = z
            more = np.flatnonzero(z < length[c])
            before[z[more], c[more]] = x[more]
            offer(x[more], z[more], c[more])
            w = before[x, c]
            more = np.flatnonzero(w >= 0)
            offer(w[more], x[more], c[more])
        ids[:, own] = symbols
        ids = ids.T
        return self.output[ids[ids >= 0]], (ids >= 0).sum(axis=1), looked

    def decode(self, ids: list[int]) -> str:
        """The text of encoded ids; the space put before the first unit goes."""
        return b"".join(map(self.text_of.__getitem__, ids))[1:].decode("utf-8", "replace")


# A run of spaces, then what is no letter, then letters; a literal sign of a space alone.
UNITS = regex.compile(rf"{SPACE}| *[^\p{{L}} {SPACE}]*\p{{L}}+| *[^\p{{L}} {SPACE}]+| +")


@cache
def kinds() -> np.ndarray:
    """For each character: 0 a space, 1 a letter, 2 a literal sign of a space, 3 any other."""
    out = np.full(0x110000, 3, np.uint8)
    for begin, end in ((0, 0xD800), (0xE000, 0x110000)):  # without surrogates, which no text holds
        for found in regex.finditer(r"\p{L}+", "".join(map(chr, range(begin, end)))):
            out[begin + found.start(): begin + found.end()] = 1
    out[ord(" ")], out[ord(SPACE)] = 0, 2
    return out


def units_of(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts as ``UNITS`` finds them, each text with a space in front, and how many each text
    has; a null or empty text has none."""
    joined = "".join([" " + text for text in texts if text])
    code, data = np.frombuffer(joined.encode("utf-32-le"), "<u4"), joined.encode()
    size = np.array([len(text) + 1 if text else 0 for text in texts], np.int64)
    kind = kinds()[code]
    begins = np.ones(len(code), bool)
    now, last = kind[1:], kind[:-1]
    begins[1:] = (now == 0) & (last != 0) | (now == 3) & (last == 1) | (now == 2) | (last == 2)
    first = np.cumsum(size) - size
    begins[first[size > 0]] = True
    bytes_before = np.append(0, np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), dtype=np.int64))
    at = np.flatnonzero(begins)
    offsets = np.append(bytes_before[at], len(data))
    found = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
    return found, np.diff(np.searchsorted(at, np.append(first, len(code))))


class Units:
    """Distinct units, ready to be merged."""

    def __init__(self, pieces: Pieces, units: list[str]):
        self.pieces, self.units = pieces, units
        code = np.frombuffer("".join(units).encode("utf-32-le"), "<u4")
        self.length = np.fromiter(map(len, units), np.int64, len(units))
        self.begin = np.cumsum(self.length) - self.length
        self.symbols = pieces.symbol_of[code]
        # What holds a character without a piece, or is long, is merged on its own.
        outside = np.append(0, np.cumsum(self.symbols < 0))
        plain = outside[self.begin + self.length] == outside[self.begin]
        self.alone = ~plain | (self.length > LENGTHS[-1])

    def merged(self, which: np.ndarray, keys: np.ndarray | None, bar: int) -> tuple[np.ndarray, ...]:
        """All ids of some units, where those of each begin and end, and how many candidates
        it took; without keys nothing is skipped."""
        begin, size, looked = (np.zeros(len(which), np.int64) for _ in range(3))
        parts, total = [np.empty(0, np.int32)], 0
        band = np.where(self.alone[which], len(LENGTHS), np.searchsorted(LENGTHS, self.length[which]))
        for n, height in enumerate(LENGTHS):
            at = np.flatnonzero(band == n)
            if not len(at):
                continue
            unit = which[at]
            row = np.arange(height)[:, None]
            inside = row < self.length[unit]
            symbols = np.where(inside, self.symbols[np.minimum(self.begin[unit] + row, len(self.symbols) - 1)], -1)
            skip = None if keys is None else lambda c, ordinal, own=keys[at]: skipped(own[c], ordinal, bar)
            ids, size[at], looked[at] = self.pieces.merge_many(symbols, self.length[unit], skip)
            begin[at] = total + np.cumsum(size[at]) - size[at]
            parts.append(ids)
            total += len(ids)
        for i in np.flatnonzero(band == len(LENGTHS)).tolist():
            unit, bits = self.units[which[i]], 0
            if keys is not None:  # every merge offers two new pairs at most
                bits = int.from_bytes(drawn(keys[i: i + 1], 3 * len(unit), bar).tobytes(), "little")
            if unit == SPACE:
                ids = [self.pieces.bytes[b] for b in SPACE.encode()]
            else:
                ids, looked[i] = self.pieces.merge(unit.replace(" ", SPACE), bits)
            parts.append(np.array(ids, np.int32))
            begin[i], size[i] = total, len(ids)
            total += len(ids)
        return np.concatenate(parts), begin, size, looked


class Encoder:
    """Encodes texts under dropout; holds the model and nothing else."""

    def __init__(self, pieces: Pieces, dropout: float, seed: int):
        self.pieces = pieces
        self.seed = mix(np.array([seed & (1 << 64) - 1], np.uint64))
        self.bar = round(dropout * (1 << 32))

    def encode_many(self, texts: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each end; ``keys`` are the texts'
        identities in the skip bits."""
        found, count = units_of(texts)
        if not len(found):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        coded = found.dictionary_encode()
        unit = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        known = Units(self.pieces, coded.dictionary.to_pylist())
        pool, begin, size, taken = known.merged(np.arange(len(known.units)), None, 0)
        begin, size = begin[unit], size[unit]
        if self.bar:
            position = np.arange(len(unit)) - np.repeat(np.cumsum(count) - count, count)
            start = mix(mix(keys.view(np.uint64) ^ self.seed))
            own = mix(position.astype(np.uint64) + np.repeat(start, count))
            bits = drawn(own, LANES, self.bar).view("<u2")[:, 0].astype(np.int64)
            varied = (bits & (1 << np.minimum(taken, LANES))[unit] - 1 != 0) | (taken[unit] > LANES)
            at = np.flatnonzero(varied)
            more, first, number, _ = known.merged(unit[at], own[at], self.bar)
            begin[at], size[at] = first + len(pool), number
            pool = np.concatenate([pool, more])
        ends = np.cumsum(size)
        ids = pool[np.repeat(begin - ends + size, size) + np.arange(ends[-1])]
        return ids, np.append(0, ends)[np.cumsum(count)]

    def encode(self, text: str, key: int) -> list[int]:
        return self.encode_many([text], np.array([key & (1 << 64) - 1], np.uint64))[0].tolist()


@cache
def load(model_path: str) -> Pieces:
    return Pieces(model_path)


def encoded(docs: DataFrame, model_path: str = MODEL, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """Ids of every text under merge dropout, and whether decoding gives the text back.

    docs: ``doc_id, text``. Returns ``doc_id, ids, n_ids, lossless``, a row for each row
    of docs. The model is a file of a byte-fallback BPE that every executor has at
    ``model_path``. dropout 0 is the model's own encoding; seed selects another variant.

    A null text has null ids, n_ids 0 and lossless null; an empty text has no ids. Equal
    rows are encoded alike: the key of the skip bits is a hash of doc_id and text, null ids
    included. Texts are encoded whole at any length. Other columns are not read. An empty
    table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("doc_id", "text").alias("key"),
                       F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(load(model_path), dropout, seed)
        for whole in batches:
            for batch in slices(whole, 2, CHUNK):
                texts = batch.column(2).to_pylist()
                ids, ends = encoder.encode_many(texts, batch.column(1).to_numpy(zero_copy_only=False))
                null = pc.is_null(batch.column(2))
                listed = ids.tolist()
                begins = np.append(0, ends[:-1]).tolist()
                same = [None if text is None else encoder.pieces.decode(listed[a:b]) == text
                        for text, a, b in zip(texts, begins, ends.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids), mask=null)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), lists, pa.array(np.diff(ends, prepend=0)), pa.array(same, pa.bool_())],
                    names=["doc_id", "ids", "n_ids", "lossless"])

    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, n_ids bigint, lossless boolean")


def decoded(tokens: DataFrame, model_path: str = MODEL) -> DataFrame:
    """``doc_id, text`` of ``doc_id, ids``; null ids give a null text, no ids an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_path)
        for batch in batches:
            texts = [None if ids is None else pieces.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("bigint").alias("doc_id"), "ids").mapInArrow(
        run, "doc_id bigint, text string")
