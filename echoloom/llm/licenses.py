r"""License scans: a trained classifier over paragraphs, confirmed by notice templates. DataFrame operations only.

A notice may stand on one line or be wrapped over several. Features are word pairs (runs of a-z and 0-9 after
lower-casing A-Z) of the templates' vocabulary, also across line breaks but not across blank lines; one regular
expression, a trie of the vocabulary, finds them in one pass over a text. A unit begins at a line that takes part in a
pair and ends there or at a later such line, with at most one other line between two of them and as many lines at most
as the longest template has words. Every unit is classified, by its set of pairs; equal sets are classified once.

1. A multinomial logistic regression over the licence families and `unknown` learns from all windows of the templates
   that hold `CONFIRM` of one, and from a bounded sample of the corpus' distinct sets: those that hold `CONFIRM` of a
   template's pairs teach its family, the others `unknown`.
2. Calibration covers all distinct sets of the table that hold no template: a family needs a probability above what all
   but one in a thousand of these reach, and `LEAST_PROBABILITY`.
3. A prediction stands if the unit holds `CONFIRM` of the pairs of a template of the predicted family.

Of units that share a line the one that holds most of its template counts, then the shortest, then the first.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, Window, functions as F

from echoloom.llm import shared

CONFIRM = 0.6
SAMPLE = 5_000
LEAST_PROBABILITY = 0.5
QUANTILE = 0.999
UNKNOWN = "unknown"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "\x02"

# Wording of public licence notices, by family.
TEMPLATES = {
    "agpl": ("Licensed under the GNU Affero General Public License, version 3.",
             "This program is free software under the GNU Affero General Public License as published by the Free Software Foundation.",
             "SPDX-License-Identifier: AGPL-3.0-only", "Released under the AGPL v3 license."),
    "apache": ("Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "SPDX-License-Identifier: Apache-2.0", "Released under the Apache License 2.0."),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Released under the BSD 3-Clause License.", "This code is distributed under the BSD license.",
            "SPDX-License-Identifier: BSD-3-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "This article is available under CC BY 3.0."),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Licensed under CC BY-NC-SA 4.0.", "Licensed under CC BY-NC-ND 4.0."),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License."),
    "cc0": ("Released into the public domain under CC0 1.0.", "This work is dedicated to the public domain.",
            "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation.",
            "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-3.0-or-later",
            "SPDX-License-Identifier: GPL-2.0-only", "Released under the GPL v3 license."),
    "lgpl": ("Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-2.1-only",
             "This library is free software under the terms of the GNU Lesser General Public License as published by the Free Software Foundation."),
    "mit": ("Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "proprietary": ("All rights reserved.", "No part of this publication may be reproduced without prior written permission of the publisher.",
                    "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential."),
}


def _words(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(UPPER, LOWER)))


def _pairs(words) -> set[str]:
    return {f"{a} {b}" for a, b in zip(words, words[1:])}


def _pattern(phrases) -> str:
    """A trie of the phrases as a regular expression; a space stands for all between two words."""
    tree = {}
    for phrase in phrases:
        node = tree
        for c in phrase:
            node = node.setdefault(c, {})
        node[""] = {}

    def written(node):
        parts = [("[^a-z0-9]++" if c == " " else c) + written(below) for c, below in sorted(node.items()) if c]
        if not parts:
            return ""
        inner = parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"
        return f"(?:{inner})?+" if "" in node else inner
    return written(tree)


class Classifier:
    """Families (the last is unknown), weights by pair, biases, and the least probability that counts."""

    def __init__(self, templates=TEMPLATES):
        self.families = [*sorted(templates), UNKNOWN]
        self.templates = [(f, _words(t)) for f in sorted(templates) for t in templates[f]]
        self.vocabulary = sorted({p for _, w in self.templates for p in _pairs(w)})
        self.longest = max(len(w) for _, w in self.templates)
        # every pair, also where it overlaps the one before, and every line break; a blank line is seen with the break before it
        self.marks = rf"(?=((?<![a-z0-9])(?:{_pattern(self.vocabulary)})(?![a-z0-9])|\n(?:[ \t\r]*+\n)?))"

    def lines(self, docs: DataFrame) -> DataFrame:
        """(row, doc_id, lines): of every row the lines that take part in a pair, with place, own pairs, and pairs into the next line."""
        breaks = lambda t: F.startswith(t, F.lit("\n"))
        tokens = F.regexp_extract_all(F.translate(F.col("text"), UPPER, LOWER), F.lit(self.marks), F.lit(1))
        tokens = F.filter(tokens, lambda t: breaks(t) | ~F.rlike(t, F.lit(r"\n[ \t\r]*+\n")))
        written = F.transform("tokens", lambda t: F.when(t == "\n", t).when(breaks(t), F.lit("\n\f")).otherwise(F.concat(
            F.lit(MARK), F.when(F.contains(t, F.lit("\n")), F.lit("+")).otherwise(F.lit("")),
            F.regexp_replace(t, "[^a-z0-9]+", " "))))

        def numbered(paragraph, k):
            lines = F.split(paragraph, "\n")
            joined = F.zip_with(lines, F.concat(F.array(F.lit("")), lines),
                                lambda x, before: F.struct(x.alias("x"), F.contains(before, F.lit(MARK + "+")).alias("reached")))
            placed = F.transform(F.filter(joined, lambda s: s["x"].isNotNull()), lambda s, i: F.struct(
                (k.cast("long") * (1 << 32) + i).alias("at"), s["x"].alias("x"), s["reached"].alias("reached")))
            return F.transform(F.filter(placed, lambda s: (s["x"] != "") | s["reached"]), lambda s: F.struct(
                s["at"].alias("at"), F.filter(F.split(s["x"], MARK), lambda p: (p != "") & ~F.startswith(p, F.lit("+"))).alias("own"),
                F.transform(F.filter(F.split(s["x"], MARK), lambda p: F.startswith(p, F.lit("+"))),
                            lambda p: F.substring(p, 2, 1 << 30)).alias("out")))
        found = F.flatten(F.transform(F.split(F.array_join(written, ""), "\f"), numbered))
        rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", tokens.alias("tokens"))
        # fields are bound one after another, so that every step is evaluated once
        return shared.saved(rows.withColumn("tokens", F.when(F.exists("tokens", lambda t: ~breaks(t)), F.col("tokens")))
                            .select("row", "doc_id", found.alias("lines")), "licence-lines")

    def units(self, lines: DataFrame) -> DataFrame:
        """(row, at, end, pairs): units by their first and last line, with the sorted set of their pairs."""
        far = F.zip_with("lines", F.concat(F.slice("lines", 1, 1), F.col("lines")), lambda x, before: x["at"] - before["at"] > 2)
        starts = (lines.where("lines IS NOT NULL").select("row", "lines", far.alias("far"))
                  .select("row", F.explode(F.expr(f"""transform(lines, (x, i) -> slice(lines, i + 1, cast(coalesce(nullif(
                      array_position(slice(far, i + 2, {self.longest - 1}), true), 0), {self.longest}) as int)))""")).alias("ahead")))
        ends = starts.select("row", F.col("ahead")[0]["at"].alias("at"), "ahead", F.posexplode("ahead.at").alias("k", "end"))
        pairs = F.expr("array_sort(array_distinct(concat(flatten(slice(ahead.own, 1, k + 1)), flatten(slice(ahead.out, 1, k)))))")
        return shared.saved(ends.select("row", "at", "end", pairs.alias("pairs")).where(F.size("pairs") > 0), "licence-units")

    def sets(self, units: DataFrame) -> DataFrame:
        """(pairs, held): distinct sets, with the families that have a template held, and how much of it."""
        wanted = F.from_json(F.lit(json.dumps([{"family": f, "pairs": sorted(_pairs(w))} for f, w in self.templates])),
                             "array<struct<family:string,pairs:array<string>>>")
        held = F.filter(F.transform(wanted, lambda x: F.struct(
            (F.size(F.array_intersect("pairs", x["pairs"])) / F.size(x["pairs"])).alias("share"), x["family"].alias("family"))),
            lambda x: x["share"] >= CONFIRM)
        return shared.saved(units.groupBy("pairs").agg(F.count("*").alias("n")).select("pairs", held.alias("held")), "licence-sets")

    def fit(self, sets: DataFrame, sample: int = SAMPLE) -> "Classifier":
        """Learn from the templates and at most `sample` distinct sets, taken by a hash; calibrate on all sets."""
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import CountVectorizerModel
        windows = {(f, tuple(sorted(_pairs(w[i:j])))) for f, w in self.templates for i in range(len(w)) for j in range(i + 2, len(w) + 1)
                   if len(_pairs(w[i:j])) >= CONFIRM * len(_pairs(w))}
        notices = shared.literal_rows(sets.sparkSession, [{"family": f, "pairs": list(p)} for f, p in sorted(windows)],
                                      "family:string,pairs:array<string>")
        best = F.array_max("held")["family"]
        seen = shared.hash_sample(sets, sample, "pairs").select(F.coalesce(best, F.lit(UNKNOWN)).alias("family"), "pairs")
        label = F.create_map(*[x for i, f in enumerate(self.families) for x in (F.lit(f), F.lit(float(i)))])
        vectors = CountVectorizerModel.from_vocabulary(self.vocabulary, "pairs", "features", binary=True)
        rows = shared.saved(vectors.transform(notices.union(seen).withColumn("label", label[F.col("family")])
                                              .union(notices.limit(1).select(F.lit(UNKNOWN), F.expr("cast(array() as array<string>)"),
                                                                             F.lit(float(len(self.families) - 1)))))
                            .select("label", "features"), "licence-rows")
        model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60).fit(rows)
        matrix, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
        self.bias = [float(x) for x in bias]
        self.weights = {p: [float(x) for x in matrix[:, j]] for j, p in enumerate(self.vocabulary)}
        top = (self.scored(sets.where(F.size("held") == 0))
               .agg(F.percentile_approx("p", QUANTILE, 100_000)).first()[0])
        self.least = max(LEAST_PROBABILITY, top or 0.0)
        return self

    def scored(self, sets: DataFrame) -> DataFrame:
        """With p and family: the likeliest licence family and its probability, by the softmax of the summed weights.

        Each step binds its values as fields, so that none is evaluated twice.
        """
        weights = F.from_json(F.lit(json.dumps(self.weights)), "map<string,array<double>>")
        names = F.array(*map(F.lit, self.families))
        z = F.array(F.aggregate(F.col("pairs"), F.array(*[F.lit(b) for b in self.bias]), lambda total, p: F.coalesce(
            F.zip_with(total, F.try_element_at(weights, p), lambda a, b: a + b), total)))
        step = F.transform(z, lambda z: F.struct(z.alias("z"), F.array_max(z).alias("top")))
        step = F.transform(step, lambda s: F.struct(
            s["top"].alias("top"), F.aggregate(s["z"], F.lit(0.0), lambda a, x: a + F.exp(x - s["top"])).alias("total"),
            F.array_max(F.transform(F.slice(s["z"], 1, len(self.families) - 1),
                                    lambda x, i: F.struct(x.alias("x"), i.alias("i")))).alias("likely")))
        step = F.transform(step, lambda s: F.struct((F.exp(s["likely"]["x"] - s["top"]) / s["total"]).alias("p"),
                                                    F.get(names, s["likely"]["i"]).alias("family")))
        return (sets.withColumn("best", step[0]).withColumn("p", F.col("best.p")).withColumn("family", F.col("best.family")).drop("best"))

    def sure(self, sets: DataFrame) -> DataFrame:
        """(pairs, family, p, share): sets that the classifier takes for a family, and a template of that family confirms."""
        share = F.array_max(F.transform(F.filter("held", lambda x: x["family"] == F.col("family")), lambda x: x["share"]))
        return (self.scored(sets).where(F.col("p") >= self.least).select("pairs", "family", "p", share.alias("share"))
                .where("share IS NOT NULL"))


def _best(found: DataFrame) -> DataFrame:
    """(row, notices) of units (row, at, end, family, p, share).

    A unit that holds a shorter one of its family, with as much of a template, can never count: left out first, so what
    still overlaps are few. These are weighed in turn, group by group of overlapping ones.
    """
    same_start = Window.partitionBy("row", "at", "family").orderBy("end").rowsBetween(Window.unboundedPreceding, -1)
    same_end = Window.partitionBy("row", "end", "family").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    for window in (same_start, same_end):
        found = found.withColumn("inner", F.max("share").over(window)).where("inner IS NULL OR share > inner").drop("inner")
    order = Window.partitionBy("row").orderBy("at", "end", "family")
    found = (found.withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
             .withColumn("part", F.sum(F.when(F.col("at") <= F.col("reach"), 0).otherwise(1)).over(order)))
    ranked = F.sort_array(F.collect_list(F.struct(
        (-F.col("share")).alias("rank"), (F.col("end") - F.col("at")).alias("more"), "at", "end", "family", "p")))
    chosen = F.aggregate("ranked", F.slice("ranked", 1, 0), lambda taken, x: F.when(
        F.exists(taken, lambda y: (x["at"] <= y["end"]) & (y["at"] <= x["end"])), taken).otherwise(F.concat(taken, F.array(x))))
    return (found.groupBy("row", "part").agg(ranked.alias("ranked")).select("row", F.explode(chosen).alias("x"))
            .groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("x.family")), ",").alias("licenses"),
                                F.count("*").alias("n_notices"), F.max("x.p").alias("probability")))


def licenses(docs: DataFrame, classifier: Classifier | None = None) -> DataFrame:
    """(doc_id, licenses, n_notices, probability) for every row: families found, by name and joined by commas.

    n_notices counts the notices, wrapped ones once; probability is the highest. Rows without a notice, and null or
    empty texts, have licenses '' and n_notices 0 and probability null. Rows that repeat are scanned alike; whole texts are
    scanned, whatever their length; other columns are ignored; an empty table gives no rows. A `classifier` that was
    fitted before, on the sets of another table, is used as it is.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = classifier or Classifier()
    lines = model.lines(base)
    units = model.units(lines)
    sets = model.sets(units)
    if classifier is None:
        model.fit(sets)
    # units of one set may be a third of all: the sets found are written, so the join can split either side
    sure = _best(units.join(shared.saved(model.sure(sets), "licence-sure"), "pairs").drop("pairs"))
    return (lines.select("row", "doc_id").join(sure, "row", "left")
            .select("doc_id", F.coalesce("licenses", F.lit("")).alias("licenses"),
                    F.coalesce("n_notices", F.lit(0)).cast("long").alias("n_notices"), "probability"))
