"""Team decisions about issues."""

from pyspark.sql import DataFrame, functions as F

from echoloom import schemas as S
from echoloom.operators.incremental import upsert


def latest_change(changes: DataFrame, order=("decided_at",)) -> DataFrame:
    """The last change per issue. An aggregation, so a key with very many changes combines
    on the map side instead of being sorted in one task."""
    rest = [c for c in changes.columns if c != "issue_key" and c not in order]
    last = changes.groupBy("issue_key").agg(F.max(F.struct(*order, *rest)).alias("_r"))
    return last.select("issue_key", *[F.col(f"_r.{c}").alias(c) for c in [*order, *rest]]) \
        .select(*changes.columns)


def apply_decisions(decisions: DataFrame, changes: DataFrame, groups: DataFrame) -> DataFrame:
    """Last write wins per issue; a change to an unknown issue is ignored."""
    known = groups.select(F.col("key").alias("issue_key"))
    accepted = latest_change(changes.select(*S.DECISIONS.names)).join(known, "issue_key", "left_semi")
    return upsert(decisions, accepted, ["issue_key"], S.DECISIONS.names)


def saved_decisions(decisions: DataFrame, groups: DataFrame) -> DataFrame:
    names = groups.select(F.col("key").alias("issue_key"), F.col("name").alias("_name"))
    return decisions.join(names, "issue_key", "left") \
        .withColumn("issue_name", F.coalesce("_name", F.lit("Saved issue"))).drop("_name") \
        .orderBy(F.col("decided_at").desc(), "issue_key")


def issue_view(groups: DataFrame, decisions: DataFrame) -> DataFrame:
    d = decisions.withColumnRenamed("issue_key", "key")
    return groups.join(d, "key", "left").withColumn("has_decision", F.col("status").isNotNull())
