"""Issue membership, summaries and evidence."""

from pyspark.sql import DataFrame, Window as W, functions as F

from echoloom import schemas as S
from echoloom.functions import labels
from echoloom.functions.identity import issue_key, reporter_struct
from echoloom.functions.text import web_trim
from echoloom.operators import ordered

ISSUE = ["issue_cat", "issue_type"]
NEWEST = 100        # messages an issue shows inline in the summary
CHUNK = 1000        # messages per evidence row


def assign(df: DataFrame) -> DataFrame:
    """Issue type and category by the ordered keyword rules."""
    rows = labels.with_issue_type(df)
    return rows.withColumn("issue_cat", labels.issue_cat()).select(*S.GROUPED.names)


def active(df: DataFrame) -> DataFrame:
    return df.where("issue_type is not null")


def distinct_reporters(rows: DataFrame) -> DataFrame:
    """Distinct (source, user) pairs over all rows."""
    pairs = rows.select(reporter_struct().alias("r")).where("r is not null").distinct()
    return pairs.agg(F.count("*").alias("reporters"))


def issue_totals(rows: DataFrame) -> DataFrame:
    """Counts, reporters, scores and times per issue.

    Rows are first combined per (issue, source, user): the exact distinct count then needs
    no row expansion, and every buffer is fixed-width, so both levels are hash aggregations
    with map-side combine whatever the size of an issue.
    """
    has_user = F.col("user_id").isNotNull() & (F.trim("user_id") != "")
    per_user = (active(rows)
                .select(*ISSUE, "source", F.when(has_user, F.col("user_id")).alias("_user"),
                        "confidence_score", "uncertain_classification", "timestamp")
                .groupBy(*ISSUE, "source", "_user")
                .agg(F.count("*").alias("n"), F.sum("confidence_score").alias("score"),
                     F.count("confidence_score").alias("scored"),
                     F.sum(F.col("uncertain_classification").cast("bigint")).alias("flagged"),
                     F.min("timestamp").alias("first"), F.max("timestamp").alias("last")))
    total = per_user.groupBy(*ISSUE).agg(
        F.sum("n").alias("total_messages"), F.count("_user").alias("unique_users"),
        (F.sum("score") / F.nullif(F.sum("scored"), F.lit(0))).alias("avg_confidence"),
        F.sum("flagged").alias("uncertain_messages"),
        F.min("first").alias("first_reported"), F.max("last").alias("last_reported"))
    users = F.col("unique_users")
    return total.withColumnRenamed("issue_cat", "issue_category").withColumns({
        "messages_per_user": F.when(users > 0, F.col("total_messages") / users),
        "needs_review": F.col("uncertain_messages") > 0})


def _example():
    return F.struct(F.col("message_text").alias("message"), F.col("user_id").alias("user"), "source",
                    F.col("confidence_score").alias("confidence"), "sentiment", "timestamp")


def top_messages(rows: DataFrame, n: int, by=None) -> DataFrame:
    """The n newest messages per issue, with their rank."""
    latest = F.coalesce(-F.unix_micros("timestamp"), F.lit(2 ** 63 - 1))    # messages without a time come last
    return first_per_group(active(rows), by or ISSUE, [latest, F.col("source"), F.col("feedback_id")], n, "rank")


def first_per_group(rows: DataFrame, by, order, n: int, rank: str) -> DataFrame:
    """The first n rows per group by ascending `order`, with their rank.

    The place of the n-th row is found on the columns of the order alone, of which a task keeps n per group. Whole rows
    are only compared with it, one place per group, so neither a shuffle nor a sort holds rows that are not among the first.
    """
    by, place = list(by), F.struct(*[c.alias(f"_{i}") for i, c in enumerate(order)])
    ranked_by = lambda at: F.row_number().over(W.partitionBy(*by).orderBy(at))
    places = rows.select(*by, place.alias("_place"))
    last = places.withColumn(rank, ranked_by("_place")).where(F.col(rank) <= n) \
        .groupBy(*by).agg(F.max("_place").alias("_last")).alias("g")
    same = place <= F.col("g._last")
    for c in by:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}"))
    few = rows.alias("r").join(F.broadcast(last), same, "left_semi")
    return few.withColumn("_place", place).withColumn(rank, ranked_by("_place")).where(F.col(rank) <= n).drop("_place")


def issue_summary(rows: DataFrame, newest: int = None) -> DataFrame:
    """One row per issue; `example_messages` holds all its messages, newest first.

    An issue's array is one value. Where issues are too large for that, `newest` shows so
    many and `issue_examples` holds all in rows of bounded size, as `Refresh` publishes them.
    """
    order = [F.col("timestamp").desc(), "source", "feedback_id"]
    ranked_rows = top_messages(rows, newest) if newest is not None else active(rows).withColumn(
        "rank", F.row_number().over(W.partitionBy(*ISSUE).orderBy(*order)))
    return _with_examples(issue_totals(rows), ranked_rows)


def _with_examples(totals: DataFrame, ranked_rows: DataFrame) -> DataFrame:
    shown = (ranked_rows.groupBy(*ISSUE)
             .agg(F.sort_array(F.collect_list(F.struct("rank", _example().alias("e")))).alias("_x"))
             .select(F.col("issue_cat").alias("issue_category"), "issue_type",
                     F.col("_x.e").alias("example_messages")))
    # An issue may carry a NULL category in saved data: compare null-safe.
    t, s = totals.alias("t"), shown.alias("s")
    same = (F.col("t.issue_category").eqNullSafe(F.col("s.issue_category"))
            & (F.col("t.issue_type") == F.col("s.issue_type")))
    return t.join(s, same, "left").select(
        *[F.col("s.example_messages" if c == "example_messages" else f"t.{c}").alias(c)
          for c in S.SUMMARY.names])


# --- the summary by parts ----------------------------------------------------------------
# Counts, sums and times of a bucket are renewed when a run touches it; reporters are counted
# in buckets by user, from messages per (issue, source, user), which can be taken back exactly.

def part_totals(rows: DataFrame, *within) -> DataFrame:
    """Counts, sums and times per issue, and per value of `within`."""
    return active(rows).groupBy(*ISSUE, *within).agg(
        F.count("*").alias("messages"), F.sum("confidence_score").alias("score"),
        F.count("confidence_score").alias("scored"),
        F.sum(F.col("uncertain_classification").cast("bigint")).alias("flagged"),
        F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))


def user_messages(rows: DataFrame, sign: int = 1) -> DataFrame:
    """Messages per (issue, source, user), each counting `sign`."""
    named = active(rows).where(F.col("user_id").isNotNull() & (F.trim("user_id") != ""))
    return named.groupBy(*ISSUE, "source", "user_id").agg((F.count("*") * sign).alias("messages"))


def added_up(*parts: DataFrame) -> DataFrame:
    """Messages per (issue, source, user) of several counts; those that come to none are left out."""
    whole = parts[0].select(*S.USERS.names)
    for p in parts[1:]:
        whole = whole.unionByName(p.select(*S.USERS.names))
    return whole.groupBy(*ISSUE, "source", "user_id").agg(F.sum("messages").alias("messages")).where("messages <> 0")


def merged_summary(totals: DataFrame, reporters: DataFrame, newest_rows: DataFrame, newest: int = NEWEST) -> DataFrame:
    """The summary from the parts of all buckets: a few rows per issue and bucket, whatever the number of messages."""
    zero = F.lit(0).cast("long")
    users = reporters.select(*ISSUE, *[F.lit(None).cast(S.TOTALS[c].dataType).alias(c) for c in S.TOTALS.names if c not in ISSUE],
                             "reporters")
    both = totals.select(*S.TOTALS.names, zero.alias("reporters")).unionByName(users)
    total = both.groupBy(*ISSUE).agg(
        F.coalesce(F.sum("messages"), zero).alias("total_messages"), F.sum("reporters").alias("unique_users"),
        (F.sum("score") / F.nullif(F.sum("scored"), F.lit(0))).alias("avg_confidence"),
        F.sum("flagged").alias("uncertain_messages"),
        F.min("first").alias("first_reported"), F.max("last").alias("last_reported")).where("total_messages > 0")
    count = F.col("unique_users")
    total = total.withColumnRenamed("issue_cat", "issue_category").withColumns({
        "messages_per_user": F.when(count > 0, F.col("total_messages") / count),
        "needs_review": F.col("uncertain_messages") > 0})
    return _with_examples(total, top_messages(newest_rows, newest))


def issue_examples(rows: DataFrame, per_row: int = CHUNK, within=(), keep=None) -> DataFrame:
    """Every message of every issue, in rows of about `per_row` messages.

    An issue may hold a third of all messages, so its evidence is split by day (and by the
    columns `within`) and, in a day, into ceil(messages / per_row) parts by a hash of the message
    key. No message is dropped, and no array grows with the data. Messages are in time order
    within a row.

    Only days of more than one part are joined. `keep` writes and reads back these few rows, whose
    size Spark then knows: messages need no shuffle for the join where it is small.
    """
    day = F.to_date("timestamp")
    rows = active(rows).withColumn("day", day)
    parts = rows.groupBy(*ISSUE, "day", *within).agg(
        F.ceil(F.count("*") / F.lit(per_row)).alias("parts")).where("parts > 1")
    r, p = rows.alias("r"), (keep or (lambda df: df))(parts).alias("p")
    parts = F.coalesce("p.parts", F.lit(1).cast("bigint"))
    same = ((F.col("r.issue_type") == F.col("p.issue_type"))
            & F.col("r.issue_cat").eqNullSafe(F.col("p.issue_cat"))
            & F.col("r.day").eqNullSafe(F.col("p.day")))
    for c in within:
        same = same & (F.col(f"r.{c}") == F.col(f"p.{c}"))
    digest = F.md5(F.concat_ws("|", "r.source", "r.feedback_id"))
    part = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % parts
    item = F.struct("timestamp", "source", "feedback_id", _example().alias("e"))
    return (r.join(p, same, "left").select("r.*", part.alias("part"), parts.alias("parts"))
            .groupBy(F.col("issue_cat").alias("issue_category"), "issue_type", "day", "part", "parts", *within)
            .agg(F.count("*").alias("messages"), F.sort_array(F.collect_list(item)).alias("_x"))
            .select("issue_category", "issue_type", "day", "part", "parts", "messages",
                    F.col("_x.e").alias("example_messages"), *within))


def ordered_evidence(rows: DataFrame, path: str, per_range: int = ordered.RANGE) -> ordered.Ordered:
    """Every active message in the order of its issue, newest first, stored below `path`.

    `positions(within=ISSUE)` numbers the messages of each issue without a window or one value per issue.
    """
    return ordered.Ordered.write(active(rows), [F.col(c).asc() for c in ISSUE] + ordered.newest_first(), path, per_range)


def issue_groups(rows: DataFrame) -> DataFrame:
    """The read side's issue list: messages, reporters, repeat reporters, messages to review."""
    name = F.col("issue_type")
    members = rows.where(name.isNotNull() & (name != "")).select(
        F.coalesce("issue_cat", "category").alias("category"), name.alias("name"), "source",
        F.when(web_trim("user_id") != "", F.col("user_id")).alias("_user"),
        labels.web_review_flag().cast("int").alias("_review"))
    per_user = members.groupBy("category", "name", "source", "_user").agg(
        F.count("*").alias("n"), F.sum("_review").alias("review"))
    known = F.col("_user").isNotNull()
    return per_user.groupBy("category", "name").agg(
        F.sum("n").alias("messages"), F.count("_user").alias("reporters"),
        F.count(F.when(known & (F.col("n") > 1), 1)).alias("repeated_reporters"),
        F.sum("review").alias("review")).select(
        issue_key("category", "name").alias("key"), "name", "category", "messages", "reporters",
        "repeated_reporters", "review")


def ranked(groups: DataFrame) -> DataFrame:
    return groups.orderBy(F.col("messages").desc(), "name", "category")


def top_issues(groups: DataFrame, n: int = 8) -> DataFrame:
    return ranked(groups).limit(n)


def remaining_issues(groups: DataFrame, n: int = 8) -> DataFrame:
    return ranked(groups).offset(n)


def problems(groups: DataFrame) -> DataFrame:
    return groups.where("category <> 'FEATURE_REQUEST'")


def features(groups: DataFrame) -> DataFrame:
    return groups.where("category = 'FEATURE_REQUEST'")


def biggest(summary: DataFrame) -> DataFrame:
    return summary.select("issue_category", "issue_type", "total_messages", "unique_users",
                          "needs_review") \
        .orderBy(F.col("total_messages").desc(), "issue_category", "issue_type")


def names_of(groups: DataFrame, key: str) -> tuple:
    """(category, name) of an issue key, or (None, None); `groups` is the small issue list."""
    row = groups.where(F.col("key") == key).select("category", "name").first()
    return (row["category"], row["name"]) if row else (None, None)


def of_issue(category, name):
    """Rows of one issue as plain equalities, which reach the scan."""
    if name is None:
        return F.lit(False)
    own = (F.col("issue_cat") == category) | (F.col("issue_cat").isNull() & (F.col("category") == category))
    return (F.col("issue_type") == name) & own


def evidence(df: DataFrame, key: str, groups: DataFrame = None) -> DataFrame:
    """All rows of one issue, newest first. `groups` is the issue list, if it is stored."""
    names = names_of(issue_groups(df) if groups is None else groups, key)
    return df.where(of_issue(*names)) \
        .orderBy(F.col("timestamp").desc(), "source", "feedback_id")
