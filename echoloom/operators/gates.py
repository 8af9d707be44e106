"""Data-quality gates.

A step evaluates all of its gates in one aggregation and then raises for the first gate,
in the step's order, that found violations.
"""

from pyspark.sql import Column, DataFrame, functions as F

from echoloom import schemas as S
from echoloom.functions import rules as R
from echoloom.functions.text import has_contact, web_trim

STORES = ["app_store", "google_play"]


class GateFailure(ValueError):
    """A gate found violations; `gate` names it and `count` says how many."""

    def __init__(self, gate, count, message):
        super().__init__(f"{count} {message}")
        self.gate, self.count = gate, count


# --- row predicates: true for a violation ---------------------------------------------

def malformed_rating(rating="rating") -> Column:
    """Store reviews must carry an integer rating."""
    return F.col("source").isin(STORES) & F.col(rating).isNull()


def bad_record() -> Column:
    text, rating = F.col("message_text"), F.col("rating")
    return (F.col("timestamp").isNull() | text.isNull() | (F.trim(text) == "")
            | (rating.isNotNull() & ~rating.between(1, 5)))


def empty_key() -> Column:
    return (F.col("source").isNull() | F.col("feedback_id").isNull()
            | (F.trim("feedback_id") == ""))


def contact_left(cols=None) -> Column:
    return has_contact(cols)


def invalid_label() -> Column:
    score, why = F.col("confidence_score"), F.col("explanation")
    ok = (F.col("category").isin(list(S.CATEGORIES)) & score.between(0, 1)
          & (F.trim(why) != "") & F.col("sentiment").isin(S.SENTIMENTS))
    return ~F.coalesce(ok, F.lit(False))


def missing_membership() -> Column:
    return (F.col("category").isin(S.ACTIONABLE)
            & (F.col("issue_type").isNull() | F.col("issue_cat").isNull()))


def missing_snapshot_field() -> Column:
    required = ["source", "feedback_id", "message_text", "timestamp", "category", "sentiment"]
    out = F.lit(False)
    for c in required:
        out = out | F.col(c).isNull()
    return out


# --- reports: one row of counts --------------------------------------------------------

def _count(predicate: Column, weight=None) -> Column:
    one = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    return F.coalesce(F.sum(F.when(predicate, one).otherwise(F.lit(0))), F.lit(0))


def violations(df: DataFrame, weight=None, **predicates: Column) -> DataFrame:
    """checked_rows and one violation count per predicate, in one pass without a shuffle of rows.

    `weight` names a column saying how many input rows a row stands for.
    """
    rows = F.coalesce(F.sum(F.lit(1) if weight is None else F.col(weight)), F.lit(0))
    return df.agg(rows.cast("bigint").alias("checked_rows"),
                  *[_count(p, weight).cast("bigint").alias(n) for n, p in predicates.items()])


def key_violations(df: DataFrame, keys=None, weight=None, **predicates: Column) -> DataFrame:
    """As `violations`, with keys and duplicate_keys; the only shuffle carries keys and counts."""
    keys = keys or S.KEYS
    size = F.count("*") if weight is None else F.sum(weight)
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"), size.alias("_rows"),
                                    *[_count(p, weight).alias(n) for n, p in predicates.items()])
    total = [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in predicates]
    return per_key.agg(F.coalesce(F.sum("_rows"), F.lit(0)).cast("bigint").alias("checked_rows"),
                       F.count("*").alias("keys"),
                       _count(F.col("_n") > 1).cast("bigint").alias("duplicate_keys"), *total)


def enforce(counts: dict, messages: dict, metrics: dict = None) -> None:
    """Raise for the first gate in `messages` with violations, and record the count."""
    for gate, message in messages.items():
        if counts[gate]:
            if metrics is not None:
                metrics["failed"] = counts[gate]
            raise GateFailure(gate, counts[gate], message)


def row(df: DataFrame) -> dict:
    """The single row of a report."""
    return df.first().asDict()


def unique_keys(df: DataFrame, keys=None) -> DataFrame:
    keys = keys or S.KEYS
    empty = empty_key() if set(keys) == set(S.KEYS) else F.col(keys[0]).isNull()
    return key_violations(df, keys, empty_keys=empty)


def duplicate_keys(df: DataFrame, keys=None) -> DataFrame:
    keys = keys or S.KEYS
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def conflicting_payloads(df: DataFrame, keys=None, cols=None) -> DataFrame:
    """Keys that occur with more than one payload, and how many payloads.

    Equal rows collapse before the shuffle, so a key with very many copies costs one row per
    task. Timestamps are compared to the millisecond.
    """
    keys, cols = keys or S.KEYS, cols or S.BASE
    return _payload(df, cols).distinct().groupBy(*keys).agg(F.count("*").alias("versions")).where("versions > 1")


def _payload(df, cols):
    times = {c: F.date_trunc("millisecond", F.col(c)) for c in cols
             if dict(df.dtypes)[c] == "timestamp"}
    return df.select(*cols).withColumns(times) if times else df.select(*cols)


def missing_rows(expected: DataFrame, actual: DataFrame, keys=None) -> DataFrame:
    keys = keys or S.KEYS
    return expected.select(*keys).join(actual.select(*keys), keys, "left_anti")


def reconcile(summary: DataFrame, active: DataFrame) -> DataFrame:
    """Messages by summary and by rows; one row."""
    def counts(df, by_summary, by_rows):
        return df.select(by_summary.cast("bigint").alias("s"), by_rows.cast("bigint").alias("a"))

    both = counts(summary, F.col("total_messages"), F.lit(0)).unionByName(
        counts(active, F.lit(0), F.lit(1)))
    total = both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n)
                       for c, n in [("s", "summary_messages"), ("a", "active_messages")]])
    return total.withColumn("reconciles", F.col("summary_messages") == F.col("active_messages"))


# --- form validation -------------------------------------------------------------------

def validate_submissions(df: DataFrame) -> DataFrame:
    """Adds `reason` (NULL = accepted); ID is lower-cased and the message trimmed."""
    message = web_trim("message")
    size = F.length(message)
    reason = (F.when(F.col("id").isNull() | ~F.col("id").rlike(R.UUID_V4), "invalid id")
              .when(message.isNull(), "no message")
              .when((size < 10) | (size > 2000), "message length")
              .when(message.rlike(R.CONTROL_CHARS), "control characters")
              .when(~F.col("rating").between(1, 5), "rating"))
    return df.withColumns({"reason": reason, "id": F.lower("id"), "message": message})


def split_accepted(df: DataFrame):
    return df.where("reason is null").drop("reason"), df.where("reason is not null")


def validate_decisions(df: DataFrame, owner_size: int = None, note_size: int = None) -> DataFrame:
    """Adds `reason`; an unknown priority becomes NULL, owner and note are trimmed.

    With a size, a longer owner or note is a reason; nothing is cut.
    """
    key = web_trim("issue_key")

    def field(name):
        return F.when(web_trim(name) != "", web_trim(name))

    reason = (F.when(key.isNull() | ~key.rlike(R.DECISION_KEY), "issue key")
              .when(F.col("status").isNull() | ~F.col("status").isin(S.STATUSES), "status"))
    for name, size in (("owner", owner_size), ("note", note_size)):
        if size is not None:
            reason = F.coalesce(reason, F.when(F.length(web_trim(name)) > size, f"{name} length"))
    priority = F.when(F.col("priority").isin(S.PRIORITIES), F.col("priority"))
    return df.withColumns({"reason": reason, "issue_key": key, "priority": priority,
                           "owner": field("owner"), "note": field("note")})
