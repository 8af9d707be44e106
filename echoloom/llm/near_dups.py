"""Near duplicates of whole documents: an LSH forest proposes families, full shingle sets decide.

1. Every text becomes its set of distinct five-word shingles, a digest of that set and 64 minima. Equal digests are
   one class; from here on a class counts once, however many copies it has.
2. The forest has 16 orders of the signature, each beginning four places later. Classes that share the first three
   places of an order form a region. The depth follows the region: one of more than `LARGE` members grows four branches,
   each by three further places of its own, and a branch that is still as large grows four more. A pair parts at a
   larger depth only if it parts in all four branches, so depth hardly costs links (`README.md` has the rates).
3. A region is read in signature order, so neighbours have the longest common prefixes, and each class is held against
   all classes before it: at most `LARGE`. Those whose signatures agree in 36 of 64 places belong to one family (a pair
   of similarity 0.85 misses that with probability 1e-9). A task sends stars, never pairs. A region that is larger even
   with nine places is one family as a whole, without a comparison of signatures.
4. Families are components of these stars. A family's full sets meet once, in blocks of `BLOCK` shingles; block pairs are
   separate groups, so a large family spreads over tasks. Intersections are counted exactly, links sent as stars.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from echoloom.llm import shared, words

PLACES, ORDERS, STEP = 64, 16, 4
DEPTH, BRANCHES, LEVELS = 3, 4, 3
LARGE = 4096
AGREE = 36
BLOCK = 1 << 20
PERCENT = 85
KEY, LOST, LOST_ID = "__echoloom_key", "__echoloom_lost", "__echoloom_lost_id"
_KEY = np.random.default_rng(77).integers(1, 1 << 62, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_REGION = "digest binary, order int, path int, key long"
_SKETCH = "doc_id long, row_key long, n_shingles long, digest binary, signature binary"


def _sketch(batches):
    hashes = words.Permutations(PLACES, 6)
    for batch in batches:
        for t in words.pieces(batch, "text"):
            sets, offsets = words.distinct(*words.shingles(*words.word_hashes(t.column("text"))))
            sizes = np.diff(offsets)
            full = np.flatnonzero(sizes)
            digests, signatures = [None] * len(sizes), [None] * len(sizes)
            if len(full):
                minima = hashes.minima(sets, offsets[:-1][full])
                for row, i in enumerate(full):
                    digests[i] = hashlib.blake2b(sets[offsets[i]:offsets[i + 1]].tobytes(), digest_size=16).digest()
                    signatures[i] = minima[row].astype(">u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id"), t.column("row_key"), pa.array(sizes), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary())], ["doc_id", "row_key", "n_shingles", "digest", "signature"])


def _places(order: int, path: tuple = ()) -> np.ndarray:
    """The places that the last branch of `path` adds, `DEPTH` of them: all branches of an order have places of their own."""
    first, level = 0, 1
    if path:
        first = sum(BRANCHES ** k for k in range(len(path)))
        for branch in path:
            level = (level - 1) * BRANCHES + branch + 1
        first += level - 1
    return (order * STEP + first * DEPTH + np.arange(DEPTH)) % PLACES


def _region_key(signatures: np.ndarray, places: np.ndarray, parent) -> np.ndarray:
    """The region that `places` make of their parent region, or of an order for a start."""
    h = (signatures[:, places].astype(np.uint64) * _KEY[places]).sum(axis=1, dtype=np.uint64)
    return words.mix(h + words.mix(parent)).view(np.int64)


def _matrix(column) -> np.ndarray:
    """Signatures as stored, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, PLACES)


def _keys(batches):
    """Rows (digest, order, path, key): the region of each class in each order."""
    for batch in batches:
        if not batch.num_rows:
            continue
        m = _matrix(batch.column("signature"))
        keys = np.stack([_region_key(m, _places(t), np.full(len(m), t, np.uint64)) for t in range(ORDERS)], axis=1)
        order = np.tile(np.arange(ORDERS, dtype=np.int32), len(m))
        digest = batch.column("digest").take(pa.array(np.repeat(np.arange(len(m)), ORDERS)))
        yield pa.RecordBatch.from_arrays([digest, pa.array(order), pa.array(np.zeros_like(order)), pa.array(keys.ravel())],
                                         ["digest", "order", "path", "key"])


def _branches(level):
    """Rows (digest, order, path, key): the branches of members of regions at `level`; path holds the branches as digits."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _matrix(batch.column("signature"))
            order, path = batch.column("order").to_numpy(), batch.column("path").to_numpy()
            key = batch.column("key").to_numpy().view(np.uint64)
            for t, p in {*zip(order.tolist(), path.tolist())}:
                rows = np.flatnonzero((order == t) & (path == p))
                digits = tuple(p // BRANCHES ** k % BRANCHES for k in reversed(range(level)))
                digest = batch.column("digest").take(pa.array(rows))
                for branch in range(BRANCHES):
                    keys = _region_key(m[rows], _places(t, (*digits, branch)), key[rows] + np.uint64(branch + 1))
                    yield pa.RecordBatch.from_arrays(
                        [digest, pa.array(np.full(len(rows), t, np.int32)),
                         pa.array(np.full(len(rows), p * BRANCHES + branch, np.int32)), pa.array(keys)],
                        ["digest", "order", "path", "key"])
    return run


def _ranked(batches):
    """Region, signature turned to its order, and digest."""
    for batch in batches:
        if not batch.num_rows:
            continue
        m = _matrix(batch.column("signature"))
        order = batch.column("order").to_numpy()
        turned = (order.astype(np.int64)[:, None] * STEP + np.arange(PLACES)) % PLACES
        ranked = np.take_along_axis(m, turned, axis=1).astype(">u4")
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), pa.array([r.tobytes() for r in ranked], pa.binary()), batch.column("digest")],
            ["key", "ranked", "digest"])


class Sets:
    """Union-find over positions of a list."""

    def __init__(self, n=0):
        self.up = list(range(n))

    def add(self):
        self.up.append(len(self.up))

    def root(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def _stars(batches):
    """Rows arrive by (key, ranked). Each is held against its region before it; sends (a, b): member and its star's centre.

    One region is in memory: a class knows its centre, and a merge of two stars sends one more edge.
    """
    key, seen, centre = None, np.empty((0, PLACES), np.uint32), []
    for batch in batches:
        if not batch.num_rows:
            continue
        m = _matrix(batch.column("ranked")).astype(np.uint32)
        keys, digests = batch.column("key").to_numpy(), batch.column("digest").to_pylist()
        a, b = [], []
        for begin, end in _runs(keys):
            if key != keys[begin]:
                key, seen, centre = keys[begin], np.empty((0, PLACES), np.uint32), []
            rows = np.concatenate([seen, m[begin:end]])
            names = centre + digests[begin:end]
            base = len(seen)
            for i in range(base, len(rows)):
                near = np.flatnonzero(np.count_nonzero(rows[:i] == rows[i], axis=1) >= AGREE)
                if len(near):
                    stars = {names[j] for j in near}
                    first = min(stars)
                    a.append(names[i])
                    b.append(first)
                    for other in stars - {first}:
                        a.append(other)
                        b.append(first)
                    if len(stars) > 1:
                        names[:i] = [first if x in stars else x for x in names[:i]]
                    names[i] = first
            seen, centre = rows, names
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _runs(keys):
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)])


def _full_sets(batches):
    """Digest and full set of the texts."""
    for batch in batches:
        for t in words.pieces(batch, "text"):
            sets, offsets = words.distinct(*words.shingles(*words.word_hashes(t.column("text"))))
            parts = [sets[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:]) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(p, digest_size=16).digest() for p in parts], pa.binary()),
                 pa.array(parts, pa.binary())], ["digest", "full"])


def _links_of(digests, fulls, sides, percent):
    """Stars of the links within one block, or between two blocks."""
    sizes = np.array([len(x) // 8 for x in fulls], np.int64)
    order = np.argsort(sizes, kind="stable")
    ids = np.concatenate([np.frombuffer(fulls[i], np.uint64) for i in order])
    vocabulary, ids = np.unique(ids, return_inverse=True)
    sizes, sides = sizes[order], sides[order]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    mixed = sides.min() != sides.max()
    flag = np.zeros(len(vocabulary), np.int64)
    found, position = Sets(len(order)), np.arange(len(order))
    for i in range(len(order) - 1):
        last = np.searchsorted(sizes * percent, sizes[i] * 100, side="right")
        if last <= i + 1:
            continue
        own = ids[offsets[i]:offsets[i + 1]]
        flag[own] = 1
        shared_ = np.add.reduceat(flag[ids[offsets[i + 1]:offsets[last]]], offsets[i + 1:last] - offsets[i + 1])
        flag[own] = 0
        union = sizes[i] + sizes[i + 1:last] - shared_
        hit = 100 * shared_ >= percent * union
        if mixed:
            hit &= sides[i + 1:last] != sides[i]
        for j in position[i + 1:last][hit]:
            found.join(i, int(j))
    out = [(digests[order[i]], digests[order[found.root(i)]]) for i in range(len(order)) if found.root(i) != i]
    return out


def _confirm(percent):
    """Rows arrive by (family, low, high): one block or two. One group is in memory."""
    def run(batches):
        held, key = [], None

        def close():
            if len(held) > 1:
                digests, fulls, sides = zip(*held)
                pairs = _links_of(digests, fulls, np.array(sides), percent)
                if pairs:
                    a, b = zip(*pairs)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

        for batch in batches:
            for family, low, high, block, digest, full in zip(*(c.to_pylist() for c in batch.columns)):
                if (family, low, high) != key:
                    yield from close()
                    held, key = [], (family, low, high)
                held.append((digest, full, block))
        yield from close()
    return run


def _stars_of(classes: DataFrame) -> DataFrame:
    """(a, b): members of one family, from all levels of the forest."""
    signatures = classes.select("digest", "signature")
    keys, stars = signatures.mapInArrow(_keys, _REGION), None
    for level in range(LEVELS):
        keys = shared.saved(keys, f"keys-{level}")
        regions = shared.saved(keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), f"regions-{level}")
        members = keys.join(regions, "key")
        scanned = (members.where(F.col("members") <= LARGE).join(signatures, "digest").select("key", "order", "signature", "digest")
                   .mapInArrow(_ranked, "key long, ranked binary, digest binary")
                   .repartition("key").sortWithinPartitions("key", "ranked", "digest").mapInArrow(_stars, "a binary, b binary"))
        stars = scanned if stars is None else stars.union(scanned)
        if regions.where(F.col("members") > LARGE).isEmpty():
            return stars
        large = members.where(F.col("members") > LARGE)
        keys = large.join(signatures, "digest").select("key", "order", "path", "signature", "digest").mapInArrow(
            _branches(level), _REGION)
    centres = large.groupBy("key").agg(F.min("digest").alias("b"))
    return stars.union(large.join(centres, "key").select(F.col("digest").alias("a"), "b"))


def _decided(docs: DataFrame, percent: int) -> DataFrame:
    """(doc_id, row_key, n_shingles, digest, least, own): least is the first row of the component, own this row."""
    base = shared.identified(docs)
    sketches = shared.saved(base.mapInArrow(_sketch, _SKETCH), "sketch")
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    classes = shared.saved(sketches.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(own).alias("least"), F.first("signature").alias("signature"),
        F.first("n_shingles").alias("n_shingles")), "classes")

    families = shared.saved(shared.components(_stars_of(classes), "families").join(
        classes.select(F.col("digest").alias("node"), "least.row_key", "n_shingles"), "node"), "families")

    blocks = families.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK).cast("int").alias("blocks"))
    placed = (families.join(blocks, "root")
              .withColumn("block", F.expr("cast(pmod(xxhash64(node), blocks) as int)"))
              .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
              .select(F.col("node").alias("digest"), "root", "block",
                      F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")))
    full = (shared.let_through(base, shared.bit_filter(families, "row_key")).mapInArrow(
        _full_sets, "digest binary, full binary")
        .join(families.select(F.col("node").alias("digest")), "digest", "left_semi").dropDuplicates(["digest"]))
    links = (placed.join(full, "digest").select("root", "low", "high", "block", "digest", "full")
             .repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
             .mapInArrow(_confirm(percent), "a binary, b binary"))
    linked = shared.components(links, "links").join(
        classes.select(F.col("digest").alias("node"), "least"), "node")
    first = linked.groupBy("root").agg(F.min("least").alias("first"))
    named = linked.join(first, "root").select(F.col("node").alias("digest"), "first")
    # written, so that the last join deals both sides out anew and can split a digest with many copies
    labels = shared.saved(classes.select("digest", "least").join(named, "digest", "left").select(
        "digest", F.coalesce("first", "least").alias("least")), "labels")
    return sketches.select("doc_id", "row_key", "n_shingles", "digest", own.alias("own")).join(labels, "digest", "left")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of `docs`; columns but doc_id and text are ignored.

    Documents are linked if 100 * |A and B| >= percent * |A or B| over their sets of lower-cased (A-Z) five-word
    shingles; a text of one to four words is one shingle. Null, empty and blank texts have an empty set and link with
    nothing. Rows that repeat a doc_id are linked by their texts alone. A null doc_id is component_id only where no
    row of the component has an ID, and its rows have kept = false. Ties: the smallest doc_id is kept. An empty table
    gives no rows.
    """
    return (_decided(docs, percent)
            .select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id"))
                    .otherwise(F.col("least.doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`docs` with one row of each component: the smallest doc_id (null last). All columns stay.

    Rows without words are in no component: all stay, but for repeats of one doc_id, as rows equal in doc_id and text
    count once everywhere.
    """
    lost = shared.saved(_decided(docs, percent).where("digest IS NOT NULL AND NOT own <=> least")
                        .select(F.col("row_key").alias(LOST), F.col("doc_id").alias(LOST_ID)).distinct(), "lost")
    docs = docs.withColumn(KEY, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    kept = docs.join(lost, (F.col(KEY) == F.col(LOST)) & F.col("doc_id").eqNullSafe(F.col(LOST_ID)), "left_anti")
    return kept.dropDuplicates([KEY, "doc_id"]).drop(KEY)
