"""Array work on Arrow text columns: byte buffers, words and 64-bit hashes, without a Python string per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Word separators: space and 0x09 to 0x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_LETTERS = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def chunks(column: pa.Array | pa.ChunkedArray, most_bytes: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, offsets, bytes)`` of consecutive rows with about ``most_bytes`` together; a null is empty.

    A row is never divided: a longer one makes a chunk of its own.
    """
    arrays = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    first = 0
    for array in arrays:
        array = array.cast(pa.large_binary()).fill_null(b"")
        n = len(array)
        if not n:
            continue
        _, offsets, data = array.buffers()
        offsets = np.frombuffer(offsets, np.int64)[array.offset:array.offset + n + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
            end = min(end, n)
            yield first + at, offsets[at:end + 1] - offsets[at], data[offsets[at]:offsets[end]]
            at = end
        first += n


def word_spans(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word; a row's edge ends a word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~IS_SPACE[data]
    first = np.empty(len(data), bool)
    first[0] = True
    first[1:] = ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    first[edges] = True
    last = np.empty(len(data), bool)
    last[-1] = True
    last[:-1] = first[1:]
    last[:-1] |= ~inside[1:]
    return np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 16)
        for k, base in enumerate((_ODD, _INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[k] = np.multiply.accumulate(factors)
    return _powers[0], _powers[1]


def running_sums(data: np.ndarray) -> np.ndarray:
    """The running sum from which every span of ``data`` gets its hash."""
    up, _ = _power(len(data))
    running = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up[:len(data)], out=running[1:])
    return running


def hashes_of(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span."""
    _, down = _power(len(running) - 1)
    return mixed((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(running: np.ndarray, n: int) -> np.ndarray:
    """The hashes of the n bytes from every place on."""
    _, down = _power(len(running) - 1)
    size = max(0, len(running) - n)
    return mixed((running[n:n + size] - running[:size]) * down[:size] + np.uint64(n))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of every span, from one running sum over the buffer."""
    return hashes_of(running_sums(data), starts, ends)


def shingle_hashes(words: np.ndarray, per_row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word runs inside rows and their row numbers.

    ``words`` holds the word hashes of consecutive rows, ``per_row`` their counts. A row with
    fewer than n words gives its whole sequence as one shingle, a row without words nothing.
    """
    begin = np.cumsum(per_row) - per_row
    short = np.flatnonzero((per_row > 0) & (per_row < n))
    row_of = np.repeat(np.arange(len(per_row)), per_row)
    size = max(0, len(words) - n + 1)
    folded = words[:size].copy()
    for k in range(1, n):
        folded = mixed(folded * np.uint64(_ODD) + words[k:k + size])
    whole = row_of[:size] == row_of[n - 1:n - 1 + size]
    hashes, rows = folded[whole], row_of[:size][whole]
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for i, row in enumerate(short):
            h = words[begin[row]:begin[row] + 1] + per_row[row:row + 1].astype(np.uint64)
            for k in range(1, per_row[row]):
                h = mixed(h * np.uint64(_ODD) + words[begin[row] + k:begin[row] + k + 1])
            extra[i] = mixed(h)[0]
        hashes, rows = np.concatenate([hashes, extra]), np.concatenate([rows, short])
    return hashes, rows


def shingle_sets(column: pa.Array, n: int, most_bytes: int = 1 << 18) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(row, hashes, lengths)`` per row with words: its distinct n-word shingles, A-Z lower-cased.

    Hashes ascend; ``lengths`` has the bytes from a shingle's first word to its last.
    """
    for first, offsets, raw in chunks(column, most_bytes):
        data = LOWER[raw]
        starts, ends = word_spans(offsets, data)
        rows = np.searchsorted(offsets, starts, "right") - 1
        per_row = np.bincount(rows, minlength=len(offsets) - 1)
        words = span_hashes(data, starts, ends)
        hashes, owner = shingle_hashes(words, per_row, n)
        # The summed word lengths, so that white space between words does not count.
        total = np.zeros(len(words) + 1, np.int64)
        np.cumsum(ends - starts, out=total[1:])
        begin = np.cumsum(per_row) - per_row
        whole = np.maximum(0, per_row - n + 1)
        first_word = np.repeat(begin - (np.cumsum(whole) - whole), whole) + np.arange(whole.sum())
        lengths = total[first_word + n] - total[first_word] if len(first_word) else np.zeros(0, np.int64)
        short = owner[len(first_word):]
        if len(short):
            lengths = np.concatenate([lengths, total[begin[short] + per_row[short]] - total[begin[short]]])
        order = np.argsort(owner, kind="stable") if len(short) else None
        if order is not None:
            hashes, lengths, owner = hashes[order], lengths[order], owner[order]
        cuts = np.searchsorted(owner, np.arange(len(per_row) + 1))
        for row in np.flatnonzero(np.diff(cuts)):
            own, at = np.unique(hashes[cuts[row]:cuts[row + 1]], return_index=True)
            yield first + int(row), own, lengths[cuts[row]:cuts[row + 1]][at]
