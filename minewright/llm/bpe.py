"""Byte-level BPE ids of whole Arrow columns: words are found and looked up as arrays, only unseen ones are merged."""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken

from minewright.llm.words import chunks, span_hashes

OTHER, LETTER, NUMBER, SPACE = range(4)
#: White space of the tokenizers' word pattern.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Words that the table of one worker remembers; beyond, it starts anew.
REMEMBERED = 400_000


@lru_cache(1)
def _kinds() -> np.ndarray:
    kinds = np.array([{"L": LETTER, "N": NUMBER}.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    kinds[WHITE] = SPACE
    return kinds


def _byte_kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each UTF-8 byte belongs to."""
    table = _kinds()
    out = table[:256][data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        wide = np.append(data, [0, 0, 0]).astype(np.int64)
        b0, b1, b2, b3 = (wide[lead + k] & 63 for k in range(4))
        first = wide[lead]
        width = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = np.select([width == 2, width == 3], [((first & 31) << 6) | b1, ((first & 15) << 12) | (b1 << 6) | b2],
                         ((first & 7) << 18) | (b1 << 12) | (b2 << 6) | b3)
        kind = table[np.minimum(code, 0x10FFFF)]
        out[lead] = kind
        for k in (1, 2, 3):
            longer = width > k
            out[lead[longer] + k] = kind[longer]
    return out


def piece_starts(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """First bytes of the pieces into which the word pattern divides each row.

    The pattern: contractions after an apostrophe; runs of letters, of numbers or of other signs, each with one space
    before; white space, of which the last character before a word stands alone unless it is that space.
    """
    size = len(data)
    if not size:
        return np.zeros(0, np.int64)
    kind = _byte_kinds(data)
    row_start = np.zeros(size + 1, bool)
    row_start[offsets[:-1]] = True
    row_start[size] = True
    change = np.ones(size, bool)
    change[1:] = (kind[1:] != kind[:-1]) | row_start[1:-1]
    begins = np.flatnonzero(change)
    ends = np.append(begins[1:], size)
    of = kind[begins]
    start = np.zeros(size + 1, bool)
    space = of == SPACE
    start[begins[space]] = True
    runs = begins[~space]
    attached = (runs > 0) & ~row_start[runs] & (data[np.maximum(runs - 1, 0)] == 0x20)
    start[np.where(attached, runs - 1, runs)] = True
    before_word = ends[space]
    before_word = before_word[~row_start[before_word]]
    odd = before_word[data[before_word - 1] != 0x20]
    if len(odd):  # the last white space character, of one to three bytes
        last = odd - 1
        for _ in range(2):
            last = np.where((data[last] & 0xC0) == 0x80, last - 1, last)
        start[last] = True
    quote = begins[(of == OTHER) & (ends - begins == 1) & (data[begins] == 0x27)]
    if len(quote):
        quote = quote[(quote + 1 < size) & ~row_start[quote + 1] & ((quote == 0) | row_start[quote] | (data[np.maximum(quote - 1, 0)] != 0x20))]
        padded = np.append(data, [0, 0])
        a, b = padded[quote + 1], padded[quote + 2]
        b = np.where(row_start[np.minimum(quote + 2, size)], 0, b)
        one = np.isin(a, list(b"stmd"))
        two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        start[quote[one | two] + 1] = False
        start[quote[one] + 2] = True
        start[quote[two] + 3] = True
    return np.flatnonzero(start[:size])


class _Table:
    """An open-addressing hash table from 64-bit hashes to small numbers, read and written as arrays."""

    def __init__(self, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def get(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes & self.mask).astype(np.int64)
        out = np.where(self.keys[slot] == hashes, self.values[slot], -1)
        left = np.flatnonzero((out < 0) & (self.keys[slot] != 0))
        while len(left):
            slot[left] = (slot[left] + 1) & int(self.mask)
            key = self.keys[slot[left]]
            hit = key == hashes[left]
            out[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (key != 0)]
        return out

    def put(self, hashes: np.ndarray, values: np.ndarray) -> None:
        """Distinct hashes that are not in the table."""
        slot = (hashes & self.mask).astype(np.int64)
        left = np.arange(len(hashes))
        while len(left):
            free = self.keys[slot[left]] == 0
            _, first = np.unique(slot[left[free]], return_index=True)
            placed = left[free][first]
            self.keys[slot[placed]], self.values[slot[placed]] = hashes[placed], values[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slot[left] = np.where(self.keys[slot[left]] != 0, (slot[left] + 1) & int(self.mask), slot[left])


class Encoder:
    """Token ids of a rank file's vocabulary, equal to those of the same vocabulary's tokenizer file."""

    def __init__(self, ranks_path: str, remembered: int = REMEMBERED):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = ranks
        self.bpe = tiktoken.Encoding("own", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
        self.remembered = remembered
        self._forget()

    def _forget(self) -> None:
        self.table = _Table(max(8, (2 * self.remembered).bit_length()))
        self.known, self.begin, self.count = 0, np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self.flat, self.used = np.zeros(1 << 14, np.int32), 0

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = data.tobytes()
        ids = [self.bpe._encode_single_piece(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
        counts = np.fromiter(map(len, ids), np.int32, len(ids))
        found = np.fromiter((i for own in ids for i in own), np.int32, int(counts.sum()))
        while self.known + len(ids) > len(self.begin):
            self.begin, self.count = np.append(self.begin, np.zeros_like(self.begin)), np.append(self.count, np.zeros_like(self.count))
        while self.used + len(found) > len(self.flat):
            self.flat = np.append(self.flat, np.zeros_like(self.flat))
        new = slice(self.known, self.known + len(ids))
        self.begin[new], self.count[new] = self.used + np.cumsum(counts) - counts, counts
        self.flat[self.used:self.used + len(found)] = found
        self.table.put(hashes, np.arange(new.start, new.stop, dtype=np.int32))
        self.known, self.used = new.stop, self.used + len(found)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``(first row, ids, ids per row)`` of consecutive rows; a null is empty."""
        for first, offsets, data in chunks(column):
            starts = piece_starts(offsets, data)
            if not len(starts):
                yield first, np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
                continue
            ends = np.append(starts[1:], len(data))
            hashes = np.maximum(span_hashes(data, starts, ends), np.uint64(1))
            piece = self.table.get(hashes)
            unseen = np.flatnonzero(piece < 0)
            if len(unseen):
                new, at = np.unique(hashes[unseen], return_index=True)
                if self.known + len(new) > self.remembered:
                    self._forget()
                    new, at = np.unique(hashes, return_index=True)
                    unseen = np.arange(len(hashes))
                    if len(new) > self.remembered:
                        self.remembered = len(new)
                        self._forget()
                self._learn(data, new, starts[unseen[at]], ends[unseen[at]])
                piece[unseen] = self.table.get(hashes[unseen])
            counts = self.count[piece].astype(np.int64)
            behind = np.cumsum(counts)
            ids = self.flat[np.repeat(self.begin[piece] - behind + counts, counts) + np.arange(int(behind[-1]))]
            rows = np.searchsorted(offsets, starts, "right") - 1
            yield first, ids, np.bincount(rows, counts, len(offsets) - 1).astype(np.int64)


@lru_cache(2)
def encoder(ranks_path: str) -> Encoder:
    """One encoder, with the words it has met, for all tasks of a worker."""
    return Encoder(ranks_path)
