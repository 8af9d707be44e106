"""Packing documents into training sequences of bounded length, balanced by attention cost.

Tokens come from a tokenizer file of byte-level pairs that is given by its path. Texts are cut before white space after
a visible character, and between a letter and a punctuation mark, where the tokenizer's own splitting always begins anew; only distinct units are encoded,
many in one call, and remembered.

A task packs what it reads in blocks of about `BLOCK` tokens; nothing is shuffled. Within a block, whole lengths of `LENGTH`
are sequences of their own; what is left of each document goes, in descending order of size, to the sequence of least
estimated cost (tokens, and their square for attention) with room for it. The sequences just hold the tokens of the
block: as many full ones as there are, and powers of two for the rest, so nothing is padded. A document that fits nowhere
whole fills the roomiest sequence and goes on in the next.
"""

from __future__ import annotations

import heapq
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from echoloom.llm import shared, words

LENGTH, BLOCK, END = 1024, 1 << 21, 0
WIDTH = 4608  # tokens of context at which attention costs as much as all else
KNOWN = 1 << 19  # units to remember, and 16 times as many ids
TOGETHER = 2000
PIECE = 1 << 22

_SPACE = np.zeros(256, bool)
_SPACE[[10, 32]] = True
# ends and beginnings of characters that no tokenizer takes for white space; others only make units longer
_VISIBLE = np.zeros(256, bool)
_VISIBLE[33:127] = True
_MAYBE = np.zeros(256, bool)
_MAYBE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_ACCENTED = np.zeros(256, bool)  # after C3: letters, but for the signs of times and division
_ACCENTED[128:192] = True
_ACCENTED[[0x97, 0xB7]] = False
_MARK = np.zeros(256, bool)  # not the apostrophe, as some endings begin with it
_MARK[[ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[]_{}"]] = True


def price(size):
    """Estimated cost of a piece: linear in its tokens, and quadratic for attention within it."""
    return size + size * size / WIDTH


def units(data, offsets):
    """Ends of the units of all texts, and how many units each text has."""
    visible = _VISIBLE[data]
    letter = data >= 0x80
    lead2, lead3 = np.zeros(len(data), bool), np.zeros(len(data), bool)
    lead2[1:] = _MAYBE[data[:-1]]
    lead3[2:] = _MAYBE[data[:-2]]
    visible |= letter & ~lead2 & ~lead3 & ~_MAYBE[data]
    cut = np.zeros(len(data) + 1, bool)
    after_letter = _LETTER[data]
    after_letter[1:] |= (data[:-1] == 0xC3) & _ACCENTED[data[1:]]
    cut[1:-1] = (_SPACE[data[1:]] & visible[:-1]) | (_MARK[data[1:]] & after_letter[:-1])
    cut[offsets] = True
    cut[0] = False
    ends = np.flatnonzero(cut)
    return ends, np.diff(np.searchsorted(ends, offsets, side="right"))


class Encoder:
    """Token ids of text columns; remembers the ids of units one after another, up to a bound."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are text
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]  # a character of a token's name is a byte
        self._forget()

    def _forget(self):
        self.numbers: dict[str, int] = {}
        self.flat, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _encoded(self, strings):
        """(ids of all strings, how many each has). Strings that can stand in one text are encoded as one."""
        joins = [u[0] in " \n" and not u[-1].isspace() for u in strings]
        together = [i for i, j in enumerate(joins) if j]
        groups = [together[i:i + TOGETHER] for i in range(0, len(together), TOGETHER)] + [[i] for i, j in enumerate(joins) if not j]
        found, sizes = [], np.zeros(len(strings), np.int64)
        for a in range(0, len(groups), 256):
            some = groups[a:a + 256]
            texts = ["".join([strings[i] for i in g]) for g in some]
            for g, e in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                ids = np.array(e.ids, np.uint32)
                ends = np.cumsum(self.bytes[ids])
                stops = np.searchsorted(ends, np.cumsum([len(strings[i].encode()) for i in g])) + 1
                sizes[g] = np.diff(stops, prepend=0)
                found.append(ids)
        order = [i for g in groups for i in g]
        flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
        # back to the order of the strings
        starts = np.empty(len(strings), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat[_runs(starts, sizes)], sizes

    def _numbers(self, strings):
        """Numbers of the strings among what is remembered."""
        if len(self.numbers) > KNOWN or len(self.flat) > 16 * KNOWN:
            self._forget()
        get = self.numbers.get
        out = np.fromiter((get(u, -1) for u in strings), np.int64, len(strings))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            new = [strings[i] for i in missing]
            out[missing] = np.arange(len(self.numbers), len(self.numbers) + len(new))
            self.numbers.update(zip(new, out[missing].tolist()))
            ids, sizes = self._encoded(new)
            self.flat = np.concatenate([self.flat, ids])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return out

    def encode(self, column):
        """(ids of all texts with `END` after each, offsets by text)."""
        data, offsets = words.buffers(column)
        ends, counts = units(data, offsets)
        strings = pa.LargeStringArray.from_buffers(len(ends), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)),
                                                   pa.py_buffer(data)).dictionary_encode()
        numbers = self._numbers(strings.dictionary.to_numpy(zero_copy_only=False).tolist())
        which = numbers[strings.indices.to_numpy(zero_copy_only=False)]
        sizes = np.diff(self.starts)[which]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        n = stops[np.concatenate([[0], np.cumsum(counts)])]
        ids = self.flat[_runs(self.starts[which], sizes)]
        return np.insert(ids, n[1:], np.uint32(END)), n + np.arange(len(n))


def _runs(starts, sizes):
    """Places of runs, one after another."""
    stops = np.cumsum(sizes)
    return np.arange(stops[-1] if len(stops) else 0) + np.repeat(starts - stops + sizes, sizes)


def rooms(total: int, length: int) -> list[int]:
    """Capacities of the sequences that hold `total` tokens without padding."""
    return [length] * (total // length) + [1 << b for b in reversed(range(length.bit_length())) if total % length >> b & 1]


def assigned(sizes, capacities):
    """(document, start, length, sequence, offset) of every piece; sizes and capacities have equal sums.

    Documents in descending order go to the sequence of least cost that has room, of equals the tightest; one that fits
    nowhere is cut at the room of the roomiest sequence.
    """
    most = max(capacities, default=0)
    heaps = [[] for _ in range(most + 1)]
    for b, room in enumerate(capacities):
        heaps[room].append((0.0, b))
    least = np.array([h[0][0] if h else np.inf for h in heaps])
    used, out = [0] * len(capacities), []
    for i in np.argsort(-np.asarray(sizes), kind="stable").tolist():
        at, left = 0, int(sizes[i])
        while left:
            room = left + int(least[left:].argmin()) if left <= most else most
            if left > most or least[room] == np.inf:
                room = int(np.flatnonzero(least < np.inf)[-1])
            cost, b = heapq.heappop(heaps[room])
            least[room] = heaps[room][0][0] if heaps[room] else np.inf
            size = min(left, room)
            out.append((i, at, size, b, used[b]))
            used[b] += size
            if room > size:
                heapq.heappush(heaps[room - size], (cost + price(size), b))
                least[room - size] = heaps[room - size][0][0]
            at, left = at + size, left - size
    return np.array(out, np.int64).reshape(-1, 5)


def packed(sizes, length: int):
    """Pieces of one block as (document, start, length, sequence, offset), in order of documents and starts."""
    sizes = np.asarray(sizes, np.int64)
    whole, rest = sizes // length, sizes % length
    n = int(whole.sum())
    doc = np.repeat(np.arange(len(sizes)), whole)
    start = (np.arange(n) - np.repeat(np.cumsum(whole) - whole, whole)) * length
    full = np.stack([doc, start, np.full(n, length), np.arange(n), np.zeros(n, np.int64)], axis=1)
    left = assigned(rest, rooms(int(rest.sum()), length))
    left[:, 1] += (whole * length)[left[:, 0]]
    left[:, 3] += n
    out = np.concatenate([full, left])
    return out[np.lexsort((out[:, 1], out[:, 0]))]


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset); `ids` are little-endian unsigned 32-bit numbers.

    Every document's ids end with `END`; a null or empty text has that only. Every row is a document of its own, also repeated ones and those with a null doc_id. `length` is a power of two. Sequences hold `length`
    tokens, or a smaller power of two at the end of a block. sequence_id is the partition and a count, so it is the same as
    long as the input is split alike. Other columns don't matter. An empty table gives no rows.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    shared.small_batches(docs.sparkSession)

    def run(batches):
        encoder, kept, held = None, [], 0
        sequence = TaskContext.get().partitionId() << 32

        def out():
            nonlocal kept, held, sequence
            sizes = np.concatenate([np.diff(o) for _, _, o in kept])
            doc_id = pa.concat_arrays([i for i, _, _ in kept])
            flat = np.concatenate([f for _, f, _ in kept]).astype("<u4")
            kept, held = [], 0
            pieces = packed(sizes, length)
            doc, start, size, seq, offset = pieces.T
            ends = np.concatenate([[0], np.cumsum(size)]) * 4
            numbers = seq + sequence
            sequence += int(seq.max(initial=-1)) + 1
            for a in range(0, len(pieces), 8192):
                z = slice(a, a + 8192)
                bytes_ = flat.view(np.uint8)[ends[a]:ends[min(a + 8192, len(pieces))]]
                ids = pa.BinaryArray.from_buffers(pa.binary(), len(size[z]), [None, pa.py_buffer(
                    (ends[a:a + 8193] - ends[a]).astype(np.int32)), pa.py_buffer(bytes_)])
                yield pa.RecordBatch.from_arrays(
                    [doc_id.take(pa.array(doc[z])), pa.array(start[z]), pa.array(size[z]), ids, pa.array(sizes[doc[z]]),
                     pa.array(numbers[z]), pa.array(offset[z])],
                    ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            encoder = encoder or Encoder(tokenizer)
            for t in words.pieces(batch, "text", PIECE):
                flat, offsets = encoder.encode(t.column("text"))
                kept.append((t.column("doc_id"), flat, offsets))
                held += len(flat)
                if held >= block:
                    yield from out()
        if kept:
            yield from out()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, ends) of `pack`'s pieces: whole sequences, with the places where its pieces end."""
    # a sequence has at most `length` pieces
    rows = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))
    return rows.select("sequence_id", F.expr("aggregate(p, 0L, (a, x) -> a + x.length)").alias("n_tokens"),
                       F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"),
                       F.transform("p", lambda x: x["offset"] + x["length"]).alias("ends"))
