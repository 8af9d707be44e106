"""Dedup, label and issue reuse, history, diffs and keyed upserts."""

from pyspark.sql import DataFrame, functions as F

from echoloom import schemas as S
from echoloom.functions.identity import cache_key, fingerprint


def dedupe(df: DataFrame) -> DataFrame:
    """One row per distinct payload, with `_copies`.

    After the conflict gate that is one row per key. Grouping by whole rows is a hash
    aggregation with map-side combine, so many copies of one key cost one row per task.
    Payloads are equal when they agree to the millisecond; the earliest time is kept.
    """
    others = [c for c in S.BASE if c != "timestamp"]
    return (df.groupBy(*others, F.date_trunc("millisecond", "timestamp").alias("_ms"))
            .agg(F.min("timestamp").alias("timestamp"), F.count("*").alias("_copies"))
            .select(*S.BASE, "_copies"))


def align(incoming: DataFrame, old: DataFrame) -> DataFrame:
    """Incoming rows over the saved ones in one full join on the key.

    `_status` is new, changed, same or retained (saved rows absent from the load).
    """
    def side(df, name):
        return df.select(*S.KEYS, F.struct(*[F.col(c) for c in S.BASE if c not in S.KEYS]).alias(name))

    def comparable(name):
        return F.struct(*[F.date_trunc("millisecond", F.col(f"{name}.{c}")) if c == "timestamp"
                          else F.col(f"{name}.{c}") for c in S.BASE if c not in S.KEYS])

    both = side(incoming, "_new").join(side(old, "_old"), S.KEYS, "full")
    status = (F.when(F.col("_new").isNull(), "retained").when(F.col("_old").isNull(), "new")
              .when(comparable("_new").eqNullSafe(comparable("_old")), "same")
              .otherwise("changed"))
    row = F.coalesce("_new", "_old")
    return both.select(*S.KEYS, row.alias("_row"), status.alias("_status")).select(
        *S.KEYS, *[F.col(f"_row.{c}").alias(c) for c in S.BASE if c not in S.KEYS], "_status")


def retained(old: DataFrame, incoming: DataFrame) -> DataFrame:
    return old.join(incoming.select(*S.KEYS), S.KEYS, "left_anti")


def restrict(old: DataFrame, incoming: DataFrame) -> DataFrame:
    return old.join(incoming.select(*S.KEYS), S.KEYS, "left_semi")


def union_retained(incoming: DataFrame, old: DataFrame) -> DataFrame:
    return incoming.select(*S.BASE).unionByName(retained(old, incoming).select(*S.BASE))


def text_digest(col="message_text"):
    """Saved texts take part in joins as digests only, so they are not shuffled."""
    return F.sha2(col, 256)


def _same_text(text, digest):
    """Null-safe, and not a join key: rows that lie in parts by feedback key meet there."""
    return F.coalesce(text_digest(text) == F.col(digest), F.col(text).isNull() & F.col(digest).isNull())


def reuse_labels(prepared: DataFrame, prior: DataFrame) -> DataFrame:
    """Rows whose saved text is unchanged: current columns with the saved labels."""
    saved = prior.select(*S.KEYS, text_digest().alias("_text"), *S.LABELS)
    both = prepared.select(*S.BASE).join(saved, S.KEYS)
    return both.where(_same_text("message_text", "_text")).select(*S.BASE, *S.LABELS)


def pending(prepared: DataFrame, prior: DataFrame, version=None) -> DataFrame:
    """Rows without a reusable label, with their cache key.

    Keys are unique on both sides, so an anti join on key and text is the same as an anti
    join on the keys of the reused rows, with one join fewer.
    """
    saved = prior.select(*S.KEYS, text_digest().alias("_text")).alias("a")
    p = prepared.select(*S.BASE).alias("p")
    same = ((F.col("p.source") == F.col("a.source")) & (F.col("p.feedback_id") == F.col("a.feedback_id"))
            & _same_text("p.message_text", "a._text"))
    rows = p.join(saved, same, "left_anti")
    return rows.withColumn("_cache_key", cache_key(version) if version else cache_key())


def one_answer(cache: DataFrame) -> DataFrame:
    """One row per cache key, the earliest answer, whatever overlapping runs appended."""
    rest = ["classified_at", *[c for c in cache.columns if c not in ("_cache_key", "classified_at")]]
    first = cache.groupBy("_cache_key").agg(F.min(F.struct(*rest)).alias("_row"))
    return first.select("_cache_key", *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*cache.columns)


def uncached(rows: DataFrame, cache: DataFrame) -> DataFrame:
    return rows.join(cache.select("_cache_key"), "_cache_key", "left_anti")


def attach(rows: DataFrame, cache: DataFrame) -> DataFrame:
    return rows.join(cache.select("_cache_key", "classification_json", "sentiment"), "_cache_key")


def with_saved_group(analyzed: DataFrame, old: DataFrame) -> DataFrame:
    """Analyzed rows with `_saved` issue membership and `_same`: neither text nor category changed."""
    saved = old.select(*S.KEYS, text_digest().alias("_text"),
                       F.col("category").alias("_category"), F.struct(*S.ISSUES).alias("_saved"))
    same = (F.col("_saved").isNotNull() & text_digest().eqNullSafe(F.col("_text"))
            & F.col("category").eqNullSafe(F.col("_category")))
    return analyzed.select(*S.ANALYZED.names).join(saved, S.KEYS, "left").withColumn("_same", same)


def reuse_groups(analyzed: DataFrame, old: DataFrame) -> DataFrame:
    """Saved issue membership where neither text nor category changed."""
    return with_saved_group(analyzed, old).where("_same").select(
        *S.ANALYZED.names, *[F.col(f"_saved.{c}").alias(c) for c in S.ISSUES])


def _as_hashed(df: DataFrame, cols):
    """The row as `fingerprint` sees it: times to the millisecond, numbers as they are written."""
    kinds = dict(df.dtypes)
    return F.struct(*[F.date_trunc("millisecond", c).alias(c) if kinds[c] == "timestamp"
                      else F.col(c).cast("string").alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in cols])


def record_diff(left: DataFrame, right: DataFrame, cols, laid: bool = False) -> DataFrame:
    """Keys whose rows differ or that only one side has; rows travel as hashes. Where both sides lie in parts by key (`laid`)
    nothing travels, and the rows are compared themselves."""
    row = _as_hashed if laid else lambda df, cols: fingerprint(cols)
    a = left.select(*S.KEYS, row(left, cols).alias("_a"))
    b = right.select(*S.KEYS, row(right, cols).alias("_b"))
    both = a.join(b, S.KEYS, "full")
    change = (F.when(F.col("_a").isNull(), "removed").when(F.col("_b").isNull(), "added")
              .otherwise("changed"))
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*S.KEYS, change.alias("change"))


def upsert(target: DataFrame, source: DataFrame, keys, cols) -> DataFrame:
    """Source rows, and the target rows whose key the source does not have. Deletes nothing.

    The source passes through without a shuffle of its payload; only its keys are joined.
    """
    kept = target.select(*cols).join(source.select(*keys), keys, "left_anti")
    return source.select(*cols).unionByName(kept.select(*cols))


def insert_missing(target: DataFrame, source: DataFrame, key) -> DataFrame:
    """Rows of the source to append: one per key the target lacks (the first by content)."""
    fresh = source.join(target.select(key), key, "left_anti")
    rest = [c for c in source.columns if c != key]
    one = fresh.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return one.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*source.columns)
