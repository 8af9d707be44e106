r"""Spelling variants: words that differ by one inserted, deleted or replaced code point, by trie-node pairs.

1. The vocabulary is counted with map-side combine. Runs of letters `[A-Za-zÀ-ÿ]+` are words, A-Z lower-cased.
2. Nodes of the forward trie (beginnings) are numbered along the sorted words: a node belongs to the first word through
   it. The vocabulary is dealt into ranges of about `RANGE` words at cut words from a bounded sample; only beginnings of
   cut words can stand in two ranges, so these are numbered from the cut words alone, in every task alike, and all
   others within their range. Nodes of the reversed trie (ends) likewise, over the reversed words. Numbers are exact, no
   hashes, and cost one step a letter, also for very long words.
3. Every word sends pairs (node before, node after): one that skips a letter for each place, one that skips nothing for
   each gap. Words that share a skipping pair differ by a replaced letter there; a pair that skips a letter in one word
   and nothing in another is an insertion. Of a run of equal letters only the last may be skipped against a gap, so
   each two neighbours meet at one pair exactly. A pair has at most one word a letter of the alphabet, and one more.
4. Forms point to words at least twice as frequent, so chains are short; roots come by pointer doubling.
"""

from __future__ import annotations

from bisect import bisect_right
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from echoloom.llm import shared

LETTERS = r"[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_COUNT, TYPOS = 5, 3, 97
RANGE = 50_000
RANGE_BITS = 40


def vocabulary(docs: DataFrame, typos: int = TYPOS) -> DataFrame:
    """(word, n): words of `LEAST_LETTERS` code points and `LEAST_COUNT` occurrences or more in all texts.

    Where `typos` divides the crc32 of `<doc_id>:<word>` (null: empty), the word loses the code point at that crc32
    modulo its length, as planted misspellings; with typos=0 none does.
    """
    runs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(F.regexp_extract_all(
        F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(LETTERS), F.lit(0))).alias("word"))
    runs = runs.where(F.char_length("word") >= LEAST_LETTERS)
    if typos:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("word")).cast("binary"))
        runs = runs.withColumn("h", h).withColumn("at", F.expr("cast(h % char_length(word) as int)")).withColumn(
            "word", F.when(F.col("h") % typos == 0, F.expr("concat(substring(word, 1, at), substring(word, at + 2))"))
            .otherwise(F.col("word"))).where(F.char_length("word") >= LEAST_LETTERS)
    return runs.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Trie:
    """Numbers of the nodes on the way of each word, for words that come sorted; `cuts` are numbered alike in every range."""

    def __init__(self, cuts=(), first: int = 0):
        self.cuts, self.next, self.last, self.way = [], first, "", [0]
        if cuts:
            border = Trie(first=1)
            self.cuts = [(c, border.nodes(c)) for c in sorted(set(cuts))]

    def nodes(self, word: str) -> list[int]:
        """The root and a node for every letter; equal beginnings have equal nodes."""
        known, way = len(commonprefix([self.last, word])), self.way
        if self.cuts:
            at = bisect_right(self.cuts, word, key=lambda c: c[0])
            for cut, its in self.cuts[max(0, at - 1):at + 1]:
                if (k := len(commonprefix([cut, word]))) >= known:
                    known, way = k, its
        way = way[:known + 1]
        new = len(word) - known
        way.extend(range(self.next, self.next + new))
        self.next += new
        self.last, self.way = word, way
        return way


def _ranged(words: DataFrame, column: str, cuts: list[str]) -> DataFrame:
    """Rows with a column `range`, the number of cuts up to the word; a range in one task, sorted by the word."""
    def run(batches):
        for batch in batches:
            at = [bisect_right(cuts, w) for w in batch.column(column).to_pylist()]
            yield batch.append_column("range", pa.array(at, pa.int64()))
    return (words.mapInArrow(run, words.withColumn("range", F.lit(0).cast("long")).schema)
            .repartition(len(cuts) + 1, "range").sortWithinPartitions("range", column))


def _tries(cuts: list[str]):
    """A trie for every range in turn."""
    trie, current = None, None

    def of(range_):
        nonlocal trie, current
        if range_ != current:
            trie, current = Trie(cuts, (range_ + 1) << RANGE_BITS), range_
        return trie
    return of


def _forward(cuts):
    """Adds the rank in code-point order, the reversed word and the forward nodes."""
    def run(batches):
        of, count, current = _tries(cuts), 0, None
        for batch in batches:
            out = []
            for word, n, r in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "range"))):
                count = 0 if r != current else count + 1
                current = r
                out.append((r << RANGE_BITS | count, word, n, word[::-1], of(r).nodes(word)))
            names = ["rank", "word", "n", "drow", "nodes"]
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*out))) if out else {c: [] for c in names}, schema=pa.schema(
                [("rank", pa.int64()), ("word", pa.string()), ("n", pa.int64()), ("drow", pa.string()),
                 ("nodes", pa.list_(pa.int64()))]))
    return run


SEND = 100_000


def _pairs(cuts):
    """The pairs of every word, in batches of bounded size: of n letters, n that skip one and n + 1 that skip none."""
    kinds = pa.schema([("before", pa.int64()), ("after", pa.int64()), ("rank", pa.int64()), ("n", pa.int64()),
                       ("skips", pa.bool_()), ("last", pa.bool_())])

    def run(batches):
        of, out = _tries(cuts), []
        for batch in batches:
            for rank, drow, n, nodes, r in zip(*(batch.column(c).to_pylist() for c in ("rank", "drow", "n", "nodes", "range"))):
                word, ends = drow[::-1], of(r).nodes(drow)
                size = len(word)
                for i in range(size + 1):
                    out.append((nodes[i], ends[size - i], rank, n, False, False))
                    if i < size:
                        out.append((nodes[i], ends[size - i - 1], rank, n, True, word[i + 1:i + 2] != word[i]))
                    if len(out) >= SEND:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)
                        out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)
    return run


def _cuts(words: DataFrame, ranges: int) -> tuple[list[str], list[str]]:
    """Cut words of both orders from a bounded sample, 32 words a range."""
    some = [r["word"] for r in shared.hash_sample(words.select("word"), 32 * ranges, "word").collect()] if ranges > 1 else []

    def every(sample):
        sample = sorted(sample)
        return sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    return every(some), every(w[::-1] for w in some)


def neighbours(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of (word, n): (rank, word, n), and (rank, n_near, best_n, best) for the ranks with a near word.

    `best` is the rank of the near word of largest n, of equals the first in code-point order.
    """
    words = shared.saved(words, "spelling-words")
    ranges = max(1, -(-words.count() // RANGE))
    forward, backward = _cuts(words, ranges)
    ranked = shared.saved(_ranged(words, "word", forward).mapInArrow(
        _forward(forward), "rank long, word string, n long, drow string, nodes array<long>"), "spelling-ranks")
    pairs = _ranged(ranked.select("rank", "n", "drow", "nodes"), "drow", backward).mapInArrow(
        _pairs(backward), "before long, after long, rank long, n long, skips boolean, last boolean")
    # a pair's members are at most one a letter of the alphabet, and one more
    groups = (pairs.groupBy("before", "after").agg(F.collect_list(F.struct("n", "rank", "skips", "last")).alias("m"))
              .where("size(m) > 1"))
    near = groups.select(F.explode(F.expr("""
        transform(m, x -> struct(x.rank as rank,
          filter(m, y -> x.rank <> y.rank and ((x.skips and y.skips) or (x.last and not y.skips) or (y.last and not x.skips))) as near))"""))
                         .alias("x")).where("size(x.near) > 0")
    best = F.expr("array_max(transform(x.near, y -> struct(y.n as n, -y.rank as rank)))")
    near = (near.select("x.rank", F.size("x.near").alias("k"), best.alias("b")).groupBy("rank")
            .agg(F.sum("k").cast("long").alias("n_near"), F.max("b").alias("b")))
    return ranked.select("rank", "word", "n"), near.select("rank", "n_near", F.col("b.n").alias("best_n"), (-F.col("b.rank")).alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(rank, root) of acyclic links (rank, to), by pointer doubling: each round halves the longest way."""
    links = shared.saved(links.select("rank", F.col("to").alias("root")), "spelling-roots")
    while True:
        ahead = links.select(F.col("rank").alias("root"), F.col("root").alias("further"))
        joined = links.join(ahead, "root", "left")
        step = shared.saved(joined.select("rank", F.coalesce("further", "root").alias("root"),
                                          F.col("further").isNotNull().alias("moved")), "spelling-roots")
        links = step.select("rank", "root")
        if not step.where("moved").limit(1).count():
            return links


def variants(docs: DataFrame, typos: int = TYPOS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of `vocabulary`.

    `form` is the near word of largest n (of equals the first in code-point order) if that is at least twice the
    word's own n, else null with form_n; `root` is reached by following forms, the word itself without one. Null texts
    hold no words; repeated rows count each; a null doc_id counts as an empty one. Texts and words may have any length.
    Columns other than doc_id and text don't matter. An empty table gives no rows.
    """
    shared.small_batches(docs.sparkSession)
    words, near = neighbours(vocabulary(docs, typos))
    rows = shared.saved(words.join(near, "rank", "left").withColumn(
        "to", F.when(F.col("best_n") >= 2 * F.col("n"), F.col("best"))), "spelling-near")
    ends = roots(rows.where("to IS NOT NULL").select("rank", "to"))
    name = lambda key, column: rows.select(F.col("rank").alias(key), F.col("word").alias(column))
    return (rows.join(ends, "rank", "left").join(name("to", "form"), "to", "left").join(name("root", "top"), "root", "left")
            .select("word", "form", F.coalesce("top", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.when(F.col("to").isNotNull(), F.col("best_n")).alias("form_n")))
