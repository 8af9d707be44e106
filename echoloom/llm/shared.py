"""Tables in the shared folder, bounded filters, and connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from echoloom.session import scratch


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark) -> None:
    """Arrow batches of 500 rows instead of the default 10,000, as rows are whole texts; another setting stays."""
    if spark.conf.get(BATCH, "10000") == "10000":
        spark.conf.set(BATCH, "500")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to a new folder below spark.checkpoint.dir and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    small_batches(spark)
    path = scratch(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


FILTER_BITS = 25


def bit_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of 2^bits bits over 64-bit keys: 4 MB whatever the number of keys.

    With many keys it only passes more rows; a join decides after it, so results don't depend on it.
    """
    slot = F.expr(f"`{column}` & {(1 << bits) - 1}L")
    words = (keys.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def passes(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which 64-bit keys the bitmap lets through."""
    slot = keys.view(np.int64) & ((len(bitmap) << 6) - 1)
    return (bitmap[slot >> 6] >> (slot & 63)) & 1 == 1


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root) for the nodes of undirected edges (a, b); root is the smallest node reached.

    Large-star and small-star rounds: every round joins edges with per-node minima, so a node with many
    neighbours is combined before the shuffle and its edges can be split by the skew join. Each round is written.
    """
    edges = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), f"{name}-edges")

    def mark(e):
        r = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        return r["n"], r["s"]

    before = mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        edges = saved(small, f"{name}-round")
        now = mark(edges)
        if now == before:
            break
        before = now
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, text and row_key: rows equal in doc_id and text have one key and get one decision."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .withColumn("row_key", F.xxhash64("doc_id", "text"))


def let_through(df: DataFrame, bitmap: np.ndarray, column: str = "row_key") -> DataFrame:
    """Rows whose key may be in the bitmap."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(passes(bitmap, batch.column(column).to_numpy())))
    return df.mapInArrow(run, df.schema)


def hash_sample(df: DataFrame, most: int, *keys: str) -> DataFrame:
    """The `most` rows of the least hash of `keys`, with that hash as `turn`; ties by the keys.

    Rows are counted first, and only those below a hash that lets about 2 * most + 100 rows through are sorted: what
    tasks send doesn't grow with their number.
    """
    total = df.count()
    below = min(1.0, (2 * most + 100) / max(1, total)) * float(1 << 63)
    turn = F.shiftrightunsigned(F.xxhash64(*keys), 1)
    return (df.withColumn("turn", turn).where(F.col("turn").cast("double") <= below)
            .orderBy("turn", *keys).limit(most))


def literal_rows(spark, rows: list[dict], kind: str) -> DataFrame:
    """A small table from a parameter, as one literal: `kind` is its struct in DDL."""
    import json
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")))
