"""From raw documents to a training mix, in five stages, each written before the next one reads it.

Every stage keeps empty tables empty, null and empty texts as its operator says, and the columns of its input. The last one
adds what the mix takes: whoever reads its rows as a corpus repeats them by `copies` and leaves out those with 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from echoloom.llm import shared
from echoloom.llm.decontaminate import decontaminate
from echoloom.llm.line_chunks import dedup_lines
from echoloom.llm.mixing import mix
from echoloom.llm.near_dups import one_of_each
from echoloom.llm.quality import accepted

NEAR_PERCENT = 80


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return accepted(docs, _table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks; a document goes if words were cut out and none are left."""
    out = dedup_lines(docs).where(r"n_removed_chunks = 0 OR text RLIKE '[^\\x20\\x09-\\x0D]'")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed_chunks") > 0, F.char_length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more."""
    return one_of_each(docs, percent=NEAR_PERCENT)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with the copies that the mix takes (0 to 2) and the words they make."""
    return mix(docs).withColumn("taken", F.col("size") * F.col("copies"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("benchmark_decontamination", leak_stage),
    ("source_mixing", mix_stage),
]

#: Hashed features, digests of line runs and Newton steps have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole table `documents`."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared.saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
