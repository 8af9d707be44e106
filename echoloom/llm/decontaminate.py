"""Benchmark decontamination: size-partitioned MinHash containment search for short items inside long documents.

Items are partitioned by the size of their shingle set into classes [W/2, W). For a class, a document is the set of its
windows of 2W shingles, one every W: an item lies whole in one of them, however long the document. So similarity is at
least 0.19 where 80 % of an item is there, and one equal minimum of 64 (missed with probability 1e-6) makes a candidate.
The minima of wider windows are minima of narrower ones, so all classes cost one pass.

Candidates are verified by the shingles themselves, as text, over the whole document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from echoloom.llm import shared, words

MINIMA = 64
CONTAINED = 0.8
_PLACE = np.random.default_rng(31).integers(1, 1 << 62, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

SHINGLE_TEXTS = r"""
transform(array(filter(split(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\\x20\\x09-\\x0D]+'), x -> x <> '')),
          w -> array_distinct(CASE WHEN size(w) >= 5
                 THEN transform(sequence(0, size(w) - 5), i -> concat_ws(' ', w[i], w[i+1], w[i+2], w[i+3], w[i+4]))
                 WHEN size(w) > 0 THEN array(concat_ws(' ', w)) ELSE cast(array() AS array<string>) END))[0]"""


def _keys(minima: np.ndarray, width: int) -> np.ndarray:
    return words.mix((minima.astype(np.uint64) + np.uint64(width << 33)) * _PLACE)


def _item_keys(batches):
    hashes = words.Permutations(MINIMA, 1)
    for batch in batches:
        for t in words.pieces(batch, "text"):
            sets, offsets = words.distinct(*words.shingles(*words.word_hashes(t.column("text"))))
            sizes = np.diff(offsets)
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            minima = hashes.minima(sets, offsets[:-1][full])
            width = 1 << np.floor(np.log2(sizes[full])).astype(np.int64) + 1
            keys = np.stack([_keys(m, int(w)) for m, w in zip(minima, width)])
            ids = pa.array(np.repeat(full, MINIMA))
            yield pa.RecordBatch.from_arrays(
                [t.column("item").take(ids), pa.array(np.repeat(width, MINIMA)), pa.array(keys.ravel().view(np.int64))],
                ["item", "width", "key"])


def _probe(bitmap, widths):
    """(doc_id, row_key, key) for the keys of all windows that may belong to an item."""
    def run(batches):
        hashes = words.Permutations(MINIMA, 1)
        for batch in batches:
            for t in words.pieces(batch, "text"):
                values, offsets = words.shingles(*words.word_hashes(t.column("text")))
                counts = -(-np.diff(offsets) // widths[0])
                if not counts.sum():
                    continue
                row = np.repeat(np.arange(len(counts)), counts)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                minima = hashes.minima(values, offsets[row] + nth * widths[0])
                rows, keys = [], []
                for k, width in enumerate(widths):
                    if k:
                        starts = np.flatnonzero((nth * widths[k - 1]) % width == 0)
                        minima = np.minimum.reduceat(minima, starts, axis=0)
                        row, nth = row[starts], nth[starts] * widths[k - 1] // width
                    window = minima.copy()
                    same = row[1:] == row[:-1]
                    window[:-1][same] = np.minimum(minima[:-1][same], minima[1:][same])
                    found = _keys(window, width)
                    at, _ = np.nonzero(hit := shared.passes(bitmap, found))
                    rows.append(row[at])
                    keys.append(found[hit])
                rows, keys = np.concatenate(rows), np.concatenate(keys)
                if len(rows):
                    both = np.unique(np.stack([rows.astype(np.uint64), keys]), axis=1)
                    at = pa.array(both[0].astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [t.column("doc_id").take(at), t.column("row_key").take(at), pa.array(both[1].view(np.int64))],
                        ["doc_id", "row_key", "key"])
    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINED) -> DataFrame:
    """(doc_id, row_key, item_id, n_shared, n_item, containment): items of which a document holds `threshold` or more.

    Containment is the share of the item's distinct five-word shingles (words of anything but space and \\t..\\r,
    A-Z lower-cased) that the document has anywhere. An item of one to four words is one shingle, which only a document
    of just these words has; null, empty and blank texts have none and never match. Items with equal texts and rows
    with equal doc_id and text are found alike; a null doc_id or item_id is returned as null. Empty tables give no
    rows. Other columns are ignored.
    """
    base = shared.identified(docs)
    items = shared.saved(benchmark.select(F.col("item_id").alias("item_id"), F.col("text").cast("string").alias("text"))
                         .withColumn("item", F.xxhash64("text")), "items")
    texts = items.groupBy("item").agg(F.first("text").alias("text"))
    item_keys = shared.saved(texts.mapInArrow(_item_keys, "item long, width long, key long"), "item-keys")
    widths = sorted(r["width"] for r in item_keys.select("width").distinct().collect())
    schema = "doc_id long, row_key long, key long"
    if widths:
        bitmap = shared.bit_filter(item_keys, "key")
        found = base.mapInArrow(_probe(bitmap, widths), schema)
    else:
        found = base.sparkSession.createDataFrame([], schema)
    candidates = shared.saved(found.join(item_keys.select("key", "item"), "key")
                              .select("row_key", "item").distinct(), "candidates")
    near = shared.let_through(base, shared.bit_filter(candidates, "row_key"))
    item_sets = texts.select("item", F.expr(SHINGLE_TEXTS.format("text")).alias("wanted"))
    doc_sets = near.join(candidates.select("row_key").distinct(), "row_key", "left_semi") \
        .select("doc_id", "row_key", F.expr(SHINGLE_TEXTS.format("text")).alias("present")).distinct()
    return (doc_sets.join(candidates, "row_key").join(item_sets, "item")
            .select("doc_id", "row_key", "item", F.size(F.array_intersect("wanted", "present")).alias("n_shared"),
                    F.size("wanted").alias("n_item"))
            .where(F.col("n_shared") >= threshold * F.col("n_item"))
            .join(items.select("item", "item_id").distinct(), "item")
            .select("doc_id", "row_key", "item_id", F.col("n_shared").cast("long").alias("n_shared"),
                    F.col("n_item").cast("long").alias("n_item"),
                    (F.col("n_shared") / F.col("n_item")).alias("containment")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = CONTAINED) -> DataFrame:
    """`docs` without the rows that hold an item; all its columns stay. Rows as in `contaminated`."""
    leaks = shared.saved(contaminated(docs, benchmark, threshold)
                         .select(F.col("row_key").alias("__echoloom_row_key"),
                                 F.col("doc_id").alias("__echoloom_doc_id")).distinct(), "leaks")
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    return docs.join(leaks, (key == F.col("__echoloom_row_key")) & docs["doc_id"].eqNullSafe(F.col("__echoloom_doc_id")), "left_anti")
