"""Quality classifier: hashed word n-gram logistic regression, learned with follow-the-regularised-leader updates.

Features of a text are its words and word pairs, and the same of word shapes (runs of capitals, letters and digits
count once, other characters as they are); a word that repeats the one before it is a pair of its own. All are hashed
into `BUCKETS` weights. A text's vector holds the share of each feature within its kind, so its length says nothing; the score is the logistic of the sparse dot product.

Learning: a bounded sample of labelled rows is dealt over `SHARDS` tasks by a hash of doc_id; each runs per-coordinate
FTRL-proximal over its rows `EPOCHS` times, and weights are averaged. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from echoloom.llm import shared, words

BUCKETS = 1 << 18
SHARDS = 8
EPOCHS = 4
MAX_LABELLED = 24_000
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.1
SCALE = 12.0
FOLDS = 5

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = 48
_SHAPE[65:91] = 65
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_KINDS = np.random.default_rng(8).integers(1, 1 << 62, 5, dtype=np.uint64)


def _shapes(column):
    """Hashes of the words' shapes, in order, as `word_hashes` gives the words."""
    data, offsets = words.buffers(column)
    shape = _SHAPE[data]
    same = np.zeros(len(data), bool)
    same[1:] = (shape[1:] == shape[:-1]) & ((shape[1:] == 65) | (shape[1:] == 97) | (shape[1:] == 48))
    same[offsets[:-1][offsets[:-1] < len(data)]] = False
    kept = shape[~same]
    ends = np.concatenate([[0], np.cumsum(~same)])[offsets]
    text = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends.astype(np.int64).tobytes()),
                                            pa.py_buffer(kept.tobytes()))
    return words.word_hashes(text, lower=False)[0]


def features(column):
    """(buckets, shares, offsets by text): the sparse vectors of the texts; a bucket may come more than once."""
    hashes, by_text = words.word_hashes(column)
    n = np.diff(by_text)
    text = np.repeat(np.arange(len(n)), n)
    pair = text[1:] == text[:-1]
    parts = []
    for kind, h in enumerate((hashes, _shapes(column))):
        parts.append((text, h ^ _KINDS[2 * kind], 1 / np.maximum(n, 1)))
        both = words.mix(h[:-1] * np.uint64(3) + h[1:])
        if kind == 0:
            both = np.where(h[1:] == h[:-1], _KINDS[4], both)
        parts.append((text[1:][pair], both[pair] ^ _KINDS[2 * kind + 1], 1 / np.maximum(n - 1, 1)))
    rows = np.concatenate([p[0] for p in parts])
    buckets = (words.mix(np.concatenate([p[1] for p in parts])) & np.uint64(BUCKETS - 1)).astype(np.int32)
    shares = np.concatenate([p[2][p[0]] for p in parts]).astype(np.float32) * SCALE
    order = np.argsort(rows, kind="stable")
    return buckets[order], shares[order], np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(n)))])


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; the last coordinate is the bias."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at=slice(None)):
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, buckets, shares, label):
        w = self.weights(buckets)
        g = (_logistic(w @ shares) - label) * shares
        step = (np.sqrt(self.n[buckets] + g * g) - np.sqrt(self.n[buckets])) / ALPHA
        self.z[buckets] += g - step * w
        self.n[buckets] += g * g


def _learn(batches):
    """Rows of a shard arrive in order; sends its non-zero weights."""
    examples = []
    for batch in batches:
        for t in words.pieces(batch, "text"):
            buckets, shares, offsets = features(t.column("text"))
            for i, label in enumerate(t.column("quality").to_pylist()):
                b, at = np.unique(buckets[offsets[i]:offsets[i + 1]], return_inverse=True)
                s = np.bincount(at, weights=shares[offsets[i]:offsets[i + 1]], minlength=len(b)).astype(np.float32)
                examples.append((np.append(b, BUCKETS).astype(np.int32), np.append(s, np.float32(1)), label))
    if not examples:
        return
    model = Ftrl(BUCKETS)
    for _ in range(EPOCHS):
        for buckets, shares, label in examples:
            model.learn(buckets, shares, label)
    w = model.weights()
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(w[at], 1.0))],
                                     ["bucket", "weight"])


def fold(column="doc_id"):
    """crc32 of the ID's text, modulo `FOLDS`."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, shards: int = SHARDS) -> np.ndarray:
    """Weights (BUCKETS + 1 numbers) from at most `max_labelled` labelled rows outside fold 0, taken by a hash of doc_id.

    Rows without a label, ID or text don't teach. With no labelled row all weights are 0 and every score 0.5. Texts are
    not shuffled to find their labels: the sample, `max_labelled` rows of three numbers at most, goes to every task.
    """
    shared.small_batches(docs.sparkSession)
    rows = shared.saved(shared.hash_sample(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold() != 0), max_labelled, "doc_id", "quality"),
        "quality-labels")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .where("text IS NOT NULL")
    examples = shared.saved(texts.join(F.broadcast(rows.distinct()), "doc_id").withColumnRenamed("turn", "dealt")
                            .dropDuplicates(["doc_id", "quality", "text"])
                            .withColumn("text_key", F.xxhash64("text")), "quality-examples")
    # an ID may stand with any number of texts: of all pairs, again the first by a hash
    keys = ["doc_id", "quality", "text_key"]
    taken = shared.saved(shared.hash_sample(examples.select(*keys), max_labelled, *keys).drop("turn").distinct(), "quality-taken")
    dealt = (examples.join(F.broadcast(taken), keys)
              .select(F.pmod("dealt", F.lit(shards)).alias("shard"), F.col("dealt").alias("turn"), "text", "quality")
              .repartition(shards, "shard").sortWithinPartitions("shard", "turn", "text"))
    got = (dealt.mapInArrow(_learn, "bucket long, weight double").groupBy("bucket")
           .agg(F.sum("weight").alias("weight")).toArrow())
    out = np.zeros(BUCKETS + 1)
    bucket, weight = got.column("bucket").to_numpy(), got.column("weight").to_numpy()
    if len(bucket):
        models = weight[bucket == -1][0]
        out[bucket[bucket >= 0]] = weight[bucket >= 0] / models
    return out.astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray, column: str = "score") -> DataFrame:
    """`docs` with a column `column` (0 to 1, higher: better); replaces a column of that name.

    Null and blank texts have no features: their score is that of the bias. All other columns stay as they are. Rows that
    repeat score alike; an empty table stays empty.
    """
    shared.small_batches(docs.sparkSession)
    docs = docs.drop(column)

    def run(batches):
        for batch in batches:
            for t in words.pieces(batch, "text"):
                buckets, shares, offsets = features(t.column("text"))
                total = np.concatenate([[0.0], np.cumsum(weights[buckets].astype(np.float64) * shares)])
                got = _logistic(total[offsets[1:]] - total[offsets[:-1]] + weights[-1])
                yield pa.RecordBatch.from_arrays([*t.columns, pa.array(got)], [*t.schema.names, column])
    schema = docs.schema.add(column, "double")
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; a null doc_id is not held out.

    A doc_id that stands several times teaches once for each of its texts and labels; equal rows teach once. An empty table
    gives no rows.
    """
    weights = train(docs, labels)
    return (score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), weights)
            .select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the rows whose score is below the threshold; columns as they are. Rows that repeat stay or go together;
    an empty table stays empty."""
    column = "__echoloom_score"
    return score(docs, train(docs, labels), column).where(F.col(column) >= threshold).drop(column)
