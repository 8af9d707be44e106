"""Words, word hashes and shingles of whole Arrow text columns, with numpy.

A word is a run of characters other than space and \\t..\\r; A-Z count as a-z where `lower` is set. Texts are read in
pieces of half a megabyte, so memory follows the words of one text at most, not the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE = 5
PIECE = 1 << 19

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20240501)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True
_BASE = 0x9E3779B97F4A7C15
_PLACE = _random.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        step = np.uint64(pow(_BASE, len(out), 1 << 64))
        out = np.concatenate([out, out * step])
    return out


_POWERS = _powers(256)


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(table, column: str, most: int = PIECE):
    """Slices of a batch with about `most` bytes of text each; a longer text is a slice of its own."""
    if not table.num_rows:
        return
    sizes = np.diff(buffers(table.column(column))[1])
    group = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip([0, *cuts], [*cuts, table.num_rows]):
        yield table.slice(int(a), int(b - a))


def _hash_piece(data, begins, lower, table):
    """Hashes, first bytes and byte lengths of the words; a word also ends at each text's begin."""
    global _POWERS
    if lower:
        data = _LOWER[data]
    at = np.arange(len(data), dtype=np.int64)
    separator = table[data]
    last = np.where(separator, at, -1)
    begins = begins[begins < len(data)]
    last[begins] = np.maximum(last[begins], begins - 1)
    place = at - np.maximum.accumulate(last) - 1
    starts = np.flatnonzero((place == 0) & ~separator)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    longest = int(place.max()) + 1
    if longest > len(_POWERS):
        _POWERS = _powers(longest)
    place[separator] = 0
    values = _BYTE[data] * _POWERS[place]
    values[separator] = 0
    sums = np.add.reduceat(values, starts)
    lengths = np.add.reduceat((~separator).astype(np.int64), starts)
    return mix(sums + lengths.astype(np.uint64) * np.uint64(_BASE)), starts, lengths


def word_hashes(column, lower=True, spans=False, table=_SEPARATOR):
    """(hashes of all words, word offsets by text); with `spans` also first byte and byte length of each word.

    Bytes count from the begin of the column's first text. Pieces end at separators or text ends.
    """
    data, offsets = buffers(column)
    if len(data) <= 2 * PIECE:
        hashes, starts, lengths = _hash_piece(data, offsets[:-1], lower, table)
        found = [(hashes, starts, lengths)]
    else:
        found, a = [], 0
        while a < len(data):
            b = min(a + PIECE, len(data))
            if b < len(data):
                step = PIECE
                while True:
                    cut = np.flatnonzero(table[data[a:b]])
                    if len(cut):
                        b = a + int(cut[-1]) + 1
                        break
                    if b == len(data):
                        break
                    b = min(b + step, len(data))
                    step *= 2
            lo, hi = np.searchsorted(offsets, [a, b])
            h, s, n = _hash_piece(data[a:b], offsets[lo:hi] - a, lower, table)
            found.append((h, s + a, n))
            a = b
    hashes, starts, lengths = (np.concatenate(x) for x in zip(*found))
    by_text = np.searchsorted(starts, offsets)
    return (hashes, by_text, starts, lengths) if spans else (hashes, by_text)


def line_hashes(column):
    """As `word_hashes` with spans, of the lines that are not empty, bytes as they are."""
    return word_hashes(column, lower=False, spans=True, table=_NEWLINE)


def shingles(hashes, by_text, size=SHINGLE):
    """(hashes of all `size`-word windows in order, offsets by text); a text of fewer words is one shingle."""
    n = np.diff(by_text)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    place = _PLACE[:size]
    if len(hashes) >= size:
        m = len(hashes) - size + 1
        rolled = np.zeros(m, np.uint64)
        for j in range(size):
            rolled += hashes[j:j + m] * place[j]
    else:
        rolled = np.zeros(0, np.uint64)
    out = np.empty(offsets[-1], np.uint64)
    full = np.repeat(n >= size, counts)
    first = np.repeat(by_text[:-1] - offsets[:-1], counts) + np.arange(offsets[-1])
    out[full] = rolled[first[full]]
    for i in np.flatnonzero((n > 0) & (n < size)):
        w = hashes[by_text[i]:by_text[i + 1]]
        out[offsets[i]] = (w * place[:len(w)]).sum() + np.uint64(len(w))
    return mix(out), offsets


def distinct(values, offsets):
    """The sorted distinct values of each text, one after another, with offsets."""
    parts = [np.unique(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


class Permutations:
    """`n` hash functions on 64-bit values, for minima over sets."""

    def __init__(self, n: int, seed: int):
        r = np.random.default_rng(seed)
        self.xor = r.integers(0, 1 << 63, n, dtype=np.uint64)
        self.times = r.integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, values, starts) -> np.ndarray:
        """uint32 matrix (sets, n): the minimum of each function over each run that begins at `starts`."""
        out = np.empty((len(starts), len(self.xor)), np.uint32)
        for k, (x, t) in enumerate(zip(self.xor, self.times)):
            h = values ^ x
            h *= t
            h >>= np.uint64(32)
            out[:, k] = np.minimum.reduceat(h, starts)
        return out
