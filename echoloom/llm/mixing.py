"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Every document gets a rate, the tilt exp(lambda * x) of its source capped at 2, where x is its size over the source's
mean size: the rates closest to 1 in relative entropy whose expected words meet the source's target. The dual has one
multiplier per source; its Newton steps run for all sources at once on (source, size) counts, each step one
aggregation, kept inside a bracket that every step narrows. A source that has not converged after `NEWTON` steps is
bisected until it has, or until no number lies between the ends of its bracket. An end that is not known yet is infinite
and found by doubling.

Rates become copies by systematic rounding: within a source, sizes in descending order, the running sum of rates is
rounded, and a document's copies are what the rounded sum grows by. Neighbours have like sizes, so a source's words
stay within about one large document of the target; one copy of a document of about that size mends most of the rest.
Equal sizes are ranked in `SALTS` groups by a hash of doc_id.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window, functions as F

from echoloom.llm import shared

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SALTS = 1024
NEWTON = 40
TOLERANCE = 1e-9
SIZE = r"size(filter(split(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), x -> x <> ''))"


def targets(totals: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(place, source, total, target) from (source, total, ...): weights by code point of the source, null last.

    A target is level * weight up to `most` times the total; the level that spends share * all words follows from the
    sources in order of total over weight. Only sources, not documents, pass the ordered windows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("place", F.row_number().over(by_name)).withColumn("weight", weight.cast("double")) \
        .withColumn("cap", F.lit(float(most)) * F.col("total"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before, everything = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    t = (t.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("level", (F.lit(float(share)) * F.sum("total").over(everything) - F.col("capped")) / F.col("open"))
         .withColumn("free", F.col("level") * F.col("weight") < F.col("cap"))
         .withColumn("level", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "place", "level")))
                     .over(everything)["level"]))
    return t.withColumn("target", F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap"))) \
        .select("place", "source", "total", "n", "target")


def _solve(cells: DataFrame, sources: DataFrame, most: float) -> DataFrame:
    """(place, lambda, full) with full for sources whose target is the cap. `cells` has (place, size, n)."""
    state = shared.saved(sources.select(
        "place", "target", (F.col("total") / F.col("n")).alias("mean"),
        (F.col("target") >= most * F.col("total") * (1 - 1e-12)).alias("full"),
        F.when(F.col("target") >= F.col("total"), 0.0).otherwise(float("-inf")).alias("lo"),
        F.when(F.col("target") >= F.col("total"), float("inf")).otherwise(0.0).alias("hi"),
        F.lit(0.0).alias("lam")).where("total > 0"), "mix-state")
    for done_steps in itertools.count():
        rate = F.least(F.exp(F.least(F.col("lam") * F.col("x"), F.lit(50.0))), F.lit(float(most)))
        moments = (cells.join(state.where("NOT full").select("place", "lam", "mean"), "place")
                   .withColumn("x", F.col("size") / F.col("mean")).withColumn("rate", rate)
                   .groupBy("place").agg(
                       F.sum(F.col("n") * F.col("size") * F.col("rate")).alias("words"),
                       F.sum(F.when(F.col("rate") < most, F.col("n") * F.col("size") * F.col("x") * F.col("rate"))
                             .otherwise(0.0)).alias("slope")))
        step = state.join(moments, "place", "left")
        over = F.col("words") - F.col("target")
        step = (step.withColumn("hi", F.when(over > 0, F.col("lam")).otherwise(F.col("hi")))
                .withColumn("lo", F.when(over < 0, F.col("lam")).otherwise(F.col("lo")))
                .withColumn("newton", F.col("lam") - F.try_divide(over, F.col("slope")))
                .withColumn("middle", F.when(F.col("hi") == float("inf"), F.col("lo") * 2 + 1)
                            .when(F.col("lo") == float("-inf"), F.col("hi") * 2 - 1).otherwise((F.col("lo") + F.col("hi")) / 2))
                .withColumn("narrow", (F.col("middle") <= F.col("lo")) | (F.col("middle") >= F.col("hi")))
                .withColumn("done", F.coalesce(F.abs(over) <= TOLERANCE * F.col("target"), F.lit(True))
                            | F.col("narrow"))
                .withColumn("lam", F.when(F.col("done"), F.col("lam"))
                            .when((F.col("newton") > F.col("lo")) & (F.col("newton") < F.col("hi")) & F.lit(done_steps < NEWTON),
                                  F.col("newton"))
                            .otherwise(F.col("middle"))))
        step = shared.saved(step.select(*state.columns, "done"), "mix-step")
        state = step.drop("done")
        if step.where("NOT done").isEmpty():
            break
    return state.select("place", "lam", "full", "mean")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """`docs` with size, source_size, target and copies; columns of these names are replaced, all others stay.

    size: words of the text (null: 0). Sources are in code point order, null last; a null source is a source of its own.
    A document of size 0 gets as many copies as its source's rate for size 0 says, but takes no words. A source without
    words has target 0 and copies 0. Copies lie between 0 and `most`; rows with equal doc_id, source and text are
    ranked one after another in any order, so the rows returned are the same in every run. An empty table stays empty.
    """
    docs = docs.drop("size", "source_size", "target", "copies")
    key = F.xxhash64(docs["doc_id"].cast("long"), docs["source"].cast("string"), docs["text"].cast("string"))
    keyed = docs.withColumn(KEY, key).withColumn("size", F.expr(SIZE).cast("long"))
    rates = copies(keyed.select("doc_id", F.col("source").cast("string").alias("source"), "size", KEY), weights, share, most)
    numbered = F.row_number().over(Window.partitionBy(KEY).orderBy("size"))
    left = keyed.withColumn(NTH, numbered)
    right = rates.withColumn(NTH, F.row_number().over(Window.partitionBy(KEY).orderBy("copies"))) \
        .select(KEY, NTH, "source_size", "target", "copies")
    return left.join(right, [KEY, NTH]).drop(KEY, NTH)


KEY, NTH = "__echoloom_key", "__echoloom_nth"


def copies(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """`rows` (doc_id, source, size, and others) with source_size, target and copies."""
    rows = shared.saved(rows, "mix-rows")
    totals = rows.groupBy("source").agg(F.sum("size").alias("total"), F.count("*").alias("n"))
    sources = shared.saved(targets(totals, weights, share, most), "mix-sources")
    placed = rows.join(sources.select("place", F.col("source").alias("__s"), F.col("total").alias("source_size"), "target"),
                       rows["source"].eqNullSafe(F.col("__s"))).drop("__s") \
        .withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    placed = shared.saved(placed, "mix-placed")
    groups = shared.saved(placed.groupBy("place", "size", "salt").agg(F.count("*").alias("n")), "mix-groups")
    cells = shared.saved(groups.groupBy("place", "size").agg(F.sum("n").alias("n")), "mix-cells")
    solved = _solve(cells, sources, most)
    rate = F.when(F.col("full"), F.lit(float(most))).otherwise(
        F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("mean"), F.lit(50.0))), F.lit(float(most))))
    cells = cells.join(solved, "place", "left").withColumn("rate", F.coalesce(rate, F.lit(0.0)))
    up_to = Window.partitionBy("place").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("sum_before", F.coalesce(F.sum(F.col("rate") * F.col("n")).over(up_to), F.lit(0.0))) \
        .select("place", "size", "rate", "sum_before")
    salted = Window.partitionBy("place", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("n_before", F.coalesce(F.sum("n").over(salted), F.lit(0))).drop("n")
    ranked = placed.withColumn("nth", F.row_number().over(
        Window.partitionBy("place", "size", "salt").orderBy(F.xxhash64("doc_id"), "doc_id", *[c for c in (KEY,) if c in rows.columns])))
    at = F.col("sum_before") + F.col("rate") * (F.col("n_before") + F.col("nth"))
    rounded = shared.saved(ranked.join(groups, ["place", "size", "salt"]).join(cells, ["place", "size"]).withColumn(
        "copies", (F.floor(at + 0.5) - F.floor(at - F.col("rate") + 0.5)).cast("long")), "mix-rounded")
    return _mended(rounded, most).select(*rows.columns, "source_size", "target", "copies")


def _mended(rounded: DataFrame, most: int) -> DataFrame:
    """One document of a source, of the size nearest to what the source lacks or exceeds, gets a copy more or less.

    Rows are combined by (place, size) before the shuffle, each with its first document that could change.
    """
    at = F.struct("salt", "nth")
    cells = shared.saved(rounded.groupBy("place", "size").agg(
        F.sum(F.col("size") * F.col("copies")).alias("words"), F.max("target").alias("target"),
        F.min(F.when(F.col("copies") < most, at)).alias("more"), F.min(F.when(F.col("copies") > 0, at)).alias("less")),
        "mix-taken")
    error = cells.groupBy("place").agg((F.max("target") - F.sum("words")).alias("error")).where("error <> 0")
    change = F.when(F.col("error") > 0, F.col("more")).otherwise(F.col("less"))
    pick = (cells.join(error, "place").withColumn("at", change)
            .where(F.col("at").isNotNull() & (F.col("size") > 0) & (F.col("size") < 2 * F.abs("error")))
            .groupBy("place").agg(F.min(F.struct(F.abs(F.abs("error") - F.col("size")).alias("off"), "size", "at",
                                                 F.signum("error").cast("long").alias("change"))).alias("p"))
            .select("place", "p.size", "p.at.salt", "p.at.nth", "p.change"))
    return rounded.join(shared.saved(pick, "mix-pick"), ["place", "size", "salt", "nth"], "left").withColumn(
        "copies", F.col("copies") + F.coalesce("change", F.lit(0)))
