"""CSV records with quoted line breaks, read by byte ranges: one large file spreads over many tasks.

1. Files are read as lines. Quotes are counted per byte range, and a running sum over the ranges of a file says which
   begin within quotes: doubled quotes don't change the parity.
2. Knowing that, each range cuts its own lines into records. What crosses a border leaves at most two pieces per range,
   which are joined in order.

Only starts of ranges and one bit for each go to the driver and to the tasks, as the list of file splits itself does.
Fields that hold quotes must be quoted, as the CSV rules ask and Spark's writer does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

WHOLE, TAIL, MIDDLE, HEAD = 0, 1, 2, 3     # a record; pieces: begun here, neither, and ended here


def ranges(lines: DataFrame) -> dict[str, dict[int, tuple[bool, bool]]]:
    """Per file: the starts of its ranges, and whether each begins and ends within quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("n"))
    so_far = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    states = counted.withColumn("after", F.sum("n").over(so_far)).select(
        "file", "start", ((F.col("after") - F.col("n")) % 2 == 1).alias("begins"), (F.col("after") % 2 == 1).alias("ends"))
    out: dict[str, dict[int, tuple[bool, bool]]] = {}
    for r in states.toLocalIterator():
        out.setdefault(r["file"], {})[r["start"]] = (r["begins"], r["ends"])
    return out


def _cut(known, pieces: bool):
    """Lines of a range to records, or (`pieces`) to the pieces at its borders: (file, start, kind, first, text)."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.int32()), ("first", pa.bool_()), ("text", pa.string())])
    def run(batches):
        at, parity, begun, first, open_ = None, 0, False, False, []

        def out(kind, texts, first=False):
            if texts and (kind != WHOLE) == pieces:
                n = len(texts)
                yield pa.RecordBatch.from_arrays([pa.array([at[0]] * n), pa.array([at[1]] * n, pa.int64()), pa.array([kind] * n, pa.int32()),
                                                  pa.array([first] * n), pa.array(texts, pa.string())], schema=schema)

        def close():
            if at is not None and open_:
                kind = (TAIL if begun else MIDDLE) if parity else (WHOLE if begun else HEAD)
                yield from out(kind, ["\n".join(open_)] if not (first and kind == WHOLE) else [], first)

        for batch in batches:
            files, starts = batch.column("file"), batch.column("start").to_numpy()
            codes = files.dictionary_encode().indices.to_numpy()
            cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(starts)]):
                if a == b:
                    continue
                here = (files[int(a)].as_py(), int(starts[a]))
                if here != at:
                    yield from close()
                    if here[1] not in known.get(here[0], {}):
                        raise ValueError(f"{here[0]} is split otherwise than when it was opened; read it again")
                    at, open_, begun = here, [], False
                    parity, first = int(known[here[0]][here[1]][0]), here[1] == 0
                if pieces and not any(known[at[0]][at[1]]):
                    open_ = []
                    continue
                values = batch.column("value").slice(int(a), int(b - a))
                after = parity + np.cumsum(pc.count_substring(values, '"').to_numpy())
                begins = np.flatnonzero(np.concatenate([[parity], after[:-1]]) % 2 == 0)
                if not len(begins):
                    open_ += values.to_pylist()
                else:
                    if len(begins) and begins[0] > 0:
                        open_ += values.slice(0, int(begins[0])).to_pylist()
                    if open_:
                        # a record of lines before this one ends
                        kind = WHOLE if begun else HEAD
                        if not (first and kind == WHOLE):
                            yield from out(kind, ["\n".join(open_)], first)
                        first = first and not begun
                    lists = pa.ListArray.from_arrays(pa.array((begins - begins[0]).astype(np.int32)),
                                                     values.slice(int(begins[0]), int(begins[-1] - begins[0])))
                    texts = pc.binary_join(lists, "\n").to_pylist()
                    if first and texts:
                        texts, first = texts[1:], False
                    yield from out(WHOLE, texts)
                    open_, begun = values.slice(int(begins[-1])).to_pylist(), True
                parity = int(after[-1]) % 2
        yield from close()
    return run, "file string, start long, kind int, first boolean, text string"


def csv_records(spark: SparkSession, path) -> DataFrame:
    """(record): every record of the CSV files but their headers, line breaks within quotes kept; blank lines are left out.

    A file that ends within quotes fails the read. The files must not change between the call and the use of the result.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    known = ranges(lines)
    run, kinds = _cut(known, False)
    whole = lines.mapInArrow(run, kinds).select("text")
    if any(any(state) for starts in known.values() for state in starts.values()):
        run, kinds = _cut(known, True)
        order = Window.partitionBy("file").orderBy("start", F.desc("kind"))
        parts = lines.mapInArrow(run, kinds).withColumn("record", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
        joined = (parts.groupBy("file", "record").agg(
            F.sort_array(F.collect_list(F.struct("start", (-F.col("kind")).alias("k"), "text"))).alias("p"),
            F.max("kind").alias("last"), F.max("first").alias("header"))
            .select(F.when(F.col("last") == HEAD, F.array_join("p.text", "\n"))
                    .otherwise(F.raise_error(F.concat(F.lit("the file ends within quotes: "), "file"))).alias("text"), "header")
            .where("NOT header").select("text"))
        whole = whole.unionByName(joined)
    text = F.regexp_replace("text", "\r$", "")
    return whole.select(text.alias("record")).where(F.trim("record") != "")

