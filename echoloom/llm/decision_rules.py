r"""Quality rules: text statistics, and a decision list learned from labelled ones. DataFrame operations only.

Statistics are array expressions over each whole text: one scan, no shuffle. Repeated five-word windows are found by
sorting packed (hash, position) numbers, so a text costs n log n whatever repeats in it.

The list is learned by sequential covering. A rule grows by the threshold condition of the highest information gain on
the growing folds, loses its last conditions while that helps on the pruning fold, and is kept if it is precise there;
the rows it covers leave. Every step reads counts per (feature, bin) that one aggregation makes, never rows. The list
becomes one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from echoloom.llm import shared

BINS = 32
MAX_LABELLED = 50_000
MAX_RULES, MAX_CONDITIONS = 8, 3
PRECISION, SUPPORT = 0.97, 4
FOLDS, HELD_OUT, PRUNE = 5, 0, 4
MIN_WORDS, REPEAT_PERCENT = 10, 20

_SPACES = r"' \t\n\u000B\u000C\r'"
_WORDS = r"filter(split(t, '[\\x20\\x09-\\x0D]+'), x -> x <> '')"
_LINES = r"filter(split(t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')"
FEATURES = {
    "n_words": "n_words",
    "mean_word": "try_divide(word_chars, n_words)",
    "symbol_share": "try_divide(n_symbols, n_words)",
    "dup_line_share": "try_divide(n_dup_lines, n_lines)",
    "repeat_share": "try_divide(n_repeat_words, n_words)",
    "upper_share": "try_divide(n_upper, word_chars)",
    "mark_share": "try_divide(n_marks, n_words)",
    "distinct_share": "try_divide(n_distinct, n_words)",
}
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks",
              "n_distinct")


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, and `STATISTICS` as long) for every row; null texts count as empty. Other columns are ignored."""
    gone = lambda chars: f"cast(char_length(t) - char_length(translate(t, {chars}, '')) AS long)"
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    d = d.select("doc_id", "t", F.expr(_WORDS).alias("w"), F.expr(_LINES).alias("lines"))
    d = d.select("doc_id", F.expr("cast(size(w) AS long)").alias("n_words"),
                 F.expr(f"cast(char_length(translate(t, {_SPACES}, '')) AS long)").alias("word_chars"),
                 F.expr(gone("'#*$%&|<>'")).alias("n_symbols"),
                 F.expr("cast(size(lines) - size(array_distinct(lines)) AS long)").alias("n_dup_lines"),
                 F.expr("cast(size(lines) AS long)").alias("n_lines"),
                 F.expr(gone("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'")).alias("n_upper"), F.expr(gone("'!?'")).alias("n_marks"),
                 F.expr("transform(w, x -> xxhash64(x))").alias("h"), F.expr("length(bin(size(w)))").alias("b"))
    d = d.withColumn("n_distinct", F.expr("cast(size(array_distinct(h)) AS long)")).withColumn("s", F.expr(
        """CASE WHEN n_words >= 6 THEN sort_array(transform(sequence(0, cast(n_words AS int) - 5),
             i -> shiftleft(xxhash64(h[i], h[i+1], h[i+2], h[i+3], h[i+4]), b) | i)) END""")).drop("h")
    d = d.withColumn("p", F.expr(
        """sort_array(filter(transform(s, (x, k) ->
             CASE WHEN coalesce(shiftright(get(s, k - 1), b) = shiftright(x, b), false)
                    OR coalesce(shiftright(get(s, k + 1), b) = shiftright(x, b), false)
                  THEN x & (shiftleft(1L, b) - 1) ELSE -1L END), x -> x >= 0))""")).drop("s")
    return d.withColumn("n_repeat_words", F.expr(
        """coalesce(aggregate(p, named_struct('stop', 0L, 'n', 0L), (a, x) ->
             named_struct('stop', x + 5, 'n', a.n + x + 5 - greatest(a.stop, x)), a -> a.n), 0L)""")) \
        .select("doc_id", *STATISTICS)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    @property
    def column(self) -> Column:
        value = F.coalesce(F.expr(FEATURES[self.feature]), F.lit(0.0))
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self):
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


def expression(rules: list[tuple[Condition, ...]]) -> Column:
    """True for rows that no rule rejects, as one ordered conditional."""
    out = None
    for rule in rules:
        hit = F.lit(True)
        for c in rule:
            hit = hit & c.column
        out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def _gain(p, n, p0, n0):
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


class _Learner:
    """Counts come from `cells`: bins of all features, whether the row grows rules, and its bad and good rows."""

    def __init__(self, cells: DataFrame, cuts: dict[str, list[float]]):
        self.cells, self.cuts = cells, cuts
        self.names = list(cuts)

    def bins(self, condition: Condition) -> Column:
        """The condition over binned features: bin b holds values from cut b - 1 on, below cut b."""
        k = self.names.index(condition.feature)
        at = self.cuts[condition.feature].index(condition.threshold) + 1
        return F.col("bins")[k] >= at if condition.above else F.col("bins")[k] < at

    def where(self, rule) -> Column:
        out = F.lit(True)
        for c in rule:
            out = out & self.bins(c)
        return out

    def grown(self) -> tuple[Condition, ...]:
        rule, rows = (), self.cells.where("grow")
        while len(rule) < MAX_CONDITIONS:
            counts = (rows.where(self.where(rule)).select(F.posexplode("bins").alias("k", "bin"), "bad", "good")
                      .groupBy("k", "bin").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect())
            table = {k: [[0, 0] for _ in range(len(c) + 1)] for k, c in enumerate(self.cuts.values())}
            for r in counts:
                table[r["k"]][r["bin"]] = [r["bad"], r["good"]]
            p0, n0 = (sum(x[i] for x in table[0]) for i in (0, 1))
            if not p0 or not n0:
                break
            best = (0.0, 0, None)
            for k, name in enumerate(self.names):
                below = [0, 0]
                for at, cut in enumerate(self.cuts[name]):
                    below = [below[i] + table[k][at][i] for i in (0, 1)]
                    for above, (p, n) in ((True, (p0 - below[0], n0 - below[1])), (False, tuple(below))):
                        if p >= SUPPORT and (gain := _gain(p, n, p0, n0)) > best[0] + 1e-9:
                            best = (gain, p, Condition(name, above, cut))
            if best[2] is None:
                break
            rule += (best[2],)
        return rule

    def pruned(self, rule) -> tuple[Condition, ...]:
        """The begin of the rule that is precise and worth most on the pruning rows, the shortest of equals; or none."""
        options = [rule[:k] for k in range(1, len(rule) + 1)]
        if not options:
            return ()
        sums = []
        for k, r in enumerate(options):
            hit = self.where(r)
            for name, on in (("prune", ~F.col("grow")), ("all", F.lit(True))):
                for what in ("bad", "good"):
                    sums.append(F.coalesce(F.sum(F.when(hit & on, F.col(what))), F.lit(0)).alias(f"{name}_{what}_{k}"))
        r = self.cells.agg(*sums).first()
        best = ((-2.0, 0), ())
        for k, option in enumerate(options):
            bad, good = r[f"all_bad_{k}"], r[f"all_good_{k}"]
            p, n = r[f"prune_bad_{k}"], r[f"prune_good_{k}"]
            if bad >= SUPPORT and bad >= PRECISION * (bad + good):
                best = max(best, (((p - n) / max(1, p + n), -k), option))
        return best[1]


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cuts the value reaches."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= value))


def learn(stats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> list[tuple[Condition, ...]]:
    """Rules that reject, in order, from at most `max_labelled` labelled rows outside fold 0, taken by a hash of doc_id.

    Rows without ID or label don't teach; without bad or good rows the list is empty. Equal inputs give equal lists.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS
    rows = shared.hash_sample(
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold != HELD_OUT), max_labelled, "doc_id", "quality")
    named = shared.saved(stats.join(rows, "doc_id").select(
        (fold != PRUNE).alias("grow"), (F.col("quality") == 0).cast("long").alias("bad"),
        *[F.coalesce(F.expr(e).cast("double"), F.lit(0.0)).alias(f) for f, e in FEATURES.items()]), "rule-rows")
    steps = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    found = named.groupBy("bad").agg(*[F.percentile(f, steps).alias(f) for f in FEATURES]).collect()
    if len(found) < 2:
        return []
    cuts = {f: sorted({v for r in found for v in r[f]}) for f in FEATURES}
    bins = F.array(*[_bin(F.col(f), c) for f, c in cuts.items()])
    cells = shared.saved(named.select("grow", bins.alias("bins"), "bad").groupBy("grow", "bins").agg(
        F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")), "rule-cells")
    learner, rules = _Learner(cells, cuts), []
    while len(rules) < MAX_RULES:
        rule = learner.pruned(learner.grown())
        if not rule:
            break
        rules.append(rule)
        learner.cells = learner.cells.where(~learner.where(rule))
    return rules


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, `STATISTICS`, base_failed, kept) for every row of `docs`.

    base_failed: fewer than 10 words, or over 20 % of them in five-word windows that the text has twice or more. kept is
    false there, else what the learned list says. Null, blank and empty texts fail. Rows that repeat are judged alike;
    an empty table gives no rows.
    """
    stats = shared.saved(statistics(docs), "statistics")
    rules = learn(stats, labels)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & expression(rules))
