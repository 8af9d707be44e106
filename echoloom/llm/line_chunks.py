"""Line dedup: runs of lines that stand elsewhere before, whatever lines surround them.

From every line begins, and at every line ends, a chunk: the shortest run of two lines or more with `LEAST` bytes or
more. So a repeated run of that size is covered by its chunks from its first to its last line. A line of `LONG_LINE`
bytes or more (about 35 words) is a chunk of its own; runs of such lines only need no others.

1. Hashes of all chunks are counted; those seen twice set bits in a bitmap of fixed size.
2. A second pass sends a digest of the bytes of chunks that the bitmap lets through, grouped by it. The first place
   (least doc_id, null last, then least position) keeps the chunk.
3. The other places are cut out of the texts, each with the line break after it. Chunks overlap: a line goes if any of
   its chunks stands elsewhere before, and equal lines stay where the earliest of these is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from echoloom.llm import shared, words

LONG_LINE = 200
LEAST = 60
SPANS = "__echoloom_spans"
COUNTS = ["n_removed_chunks", "n_removed_lines", "removed_bytes"]
_ROLL = np.uint64(0x9E3779B97F4A7C15)


def chunks(hashes, by_text, starts, lengths):
    """(first line, number of lines, hash) of every chunk of every text."""
    n, ends = len(hashes), starts + lengths
    at, texts = np.arange(n), np.repeat(np.arange(len(by_text) - 1), np.diff(by_text))
    last = np.maximum(at + 1, np.searchsorted(ends, starts + LEAST))
    first = np.minimum(at - 1, np.searchsorted(starts, ends - LEAST, side="right") - 1)
    begins = last < by_text[texts + 1]
    closes = first >= by_text[texts]
    closes[closes] = last[first[closes]] != at[closes]
    long = lengths >= LONG_LINE
    first, last = (np.concatenate(x) for x in ((at[begins], first[closes], at[long]), (last[begins], at[closes], at[long])))
    longs = np.concatenate([[0], np.cumsum(long)])
    sizes = last - first + 1
    needed = (sizes == 1) | (longs[last + 1] - longs[first] < sizes)
    first, sizes = first[needed], sizes[needed]
    order = np.lexsort((sizes, first))
    first, sizes = first[order], sizes[order]
    sums = sizes.astype(np.uint64)
    for place in range(sizes.max(initial=0)):
        held = np.flatnonzero(sizes > place)
        sums[held] += words.mix(hashes[first[held] + place] + np.uint64(place) * _ROLL)
    return first, sizes, words.mix(sums)


def _eligible(t):
    """Row, byte span, lines and hash of the chunks; byte spans count from the first text's begin."""
    hashes, by_text, starts, lengths = words.line_hashes(t.column("text"))
    if not len(hashes):
        return None
    at, sizes, keys = chunks(hashes, by_text, starts, lengths)
    last = at + sizes - 1
    return np.searchsorted(by_text, at, side="right") - 1, starts[at], starts[last] + lengths[last], sizes, keys


def _chunk_hashes(batches):
    for batch in batches:
        for t in words.pieces(batch, "text"):
            if (found := _eligible(t)) is not None:
                yield pa.RecordBatch.from_arrays([pa.array(found[4].view(np.int64))], ["hash"])


def _chunk_digests(bitmap):
    def run(batches):
        for batch in batches:
            for t in words.pieces(batch, "text"):
                if (found := _eligible(t)) is None:
                    continue
                row, begin, stop, _, _ = (x[shared.passes(bitmap, found[4])] for x in found)
                data, offsets = words.buffers(t.column("text"))
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [t.column("doc_id").take(at), t.column("row_key").take(at), pa.array(begin - offsets[row]),
                     pa.array(stop - offsets[row]),
                     pa.array([hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(begin, stop)], pa.binary())],
                    ["doc_id", "row_key", "start", "stop", "digest"])
    return run


def without(text: str, spans) -> str:
    """The text without the byte spans, in order, and the line break that follows each."""
    data, out, at = text.encode(), [], 0
    for start, stop in merged(spans):
        out.append(data[at:start])
        at = stop + 1 if data[stop:stop + 1] == b"\n" else stop
    out.append(data[at:])
    return b"".join(out).decode()


def merged(spans) -> list:
    """Spans, in order, with those that overlap made one."""
    out = []
    for start, stop in spans:
        if out and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def _cut(batches):
    """Texts without their spans, and how many separate spans, lines and bytes went."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        texts, spans = batch.column(at).to_pylist(), batch.column(SPANS).to_pylist()
        counts = np.zeros((3, len(texts)), np.int64)
        for i, s in enumerate(spans):
            if s:
                data = texts[i].encode()
                cut = merged(sorted((x["start"], x["stop"]) for x in s))
                lines = sum(len([x for x in data[a:b].split(b"\n") if x]) for a, b in cut)
                counts[:, i] = len(cut), lines, sum(b - a for a, b in cut)
                texts[i] = without(texts[i], cut)
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names if n != SPANS]
        names = [n for n in batch.schema.names if n != SPANS]
        yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, counts)], [*names, *COUNTS])


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, start, stop): byte spans to remove; they may overlap. Rows as in `dedup_lines`."""
    base = shared.identified(docs)
    twice = (base.mapInArrow(_chunk_hashes, "hash long").groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"))
    bitmap = shared.bit_filter(twice, "hash")
    places = shared.saved(base.mapInArrow(
        _chunk_digests(bitmap), "doc_id long, row_key long, start long, stop long, digest binary"), "chunks")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "start")
    places = places.withColumn("place", place)
    # written, so that the join deals both sides out anew and can split a chunk that stands everywhere
    first = shared.saved(places.groupBy("digest").agg(F.min("place").alias("first"), F.max("place").alias("last"))
                         .where(~F.col("first").eqNullSafe(F.col("last"))).drop("last"), "chunk-firsts")
    # a chunk that repeats into itself keeps its first place whole: the others go from the line after that on
    kept_to = F.when((F.col("place.row_key") == F.col("first.row_key")) & F.col("place.doc_id").eqNullSafe(F.col("first.doc_id")),
                     F.col("first.start") + F.col("stop") - F.col("start") + 1).otherwise(0)
    return (places.join(first, "digest").where(~F.col("place").eqNullSafe(F.col("first")))
            .select("doc_id", "row_key", F.greatest("start", kept_to).alias("start"), "stop"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """`docs` with repeated chunks cut out of `text`; further columns n_removed_chunks (spans cut), n_removed_lines, removed_bytes.

    A chunk of equal bytes stays at its first place only, also within one text. Rows equal in doc_id and text are one
    place and keep equal texts. Null texts stay null, empty ones empty; blank lines stay but for those within a chunk, as
    do lines that repeat alone. All columns of `docs` stay, but for columns of the three new names, which are replaced;
    row order doesn't matter. An empty table stays empty.
    """
    docs = docs.drop(*COUNTS).withColumn("text", F.col("text").cast("string"))
    spans = (repeated_chunks(docs).distinct().groupBy("doc_id", "row_key")
             .agg(F.collect_list(F.struct("start", "stop")).alias(SPANS))
             .withColumnRenamed("doc_id", "__echoloom_doc_id").withColumnRenamed("row_key", "__echoloom_row_key"))
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"])
    joined = (docs.join(spans, (key == F.col("__echoloom_row_key")) & docs["doc_id"].eqNullSafe(F.col("__echoloom_doc_id")), "left")
              .drop("__echoloom_doc_id", "__echoloom_row_key"))
    counted = joined.drop(SPANS).select("*", *[F.lit(0).cast("long").alias(c) for c in COUNTS])
    return joined.mapInArrow(_cut, counted.schema)
