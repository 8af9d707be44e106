"""Read side: filters, search, totals, trends and paging."""

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from echoloom import schemas as S
from echoloom.functions import labels
from echoloom.functions.text import search_match, web_trim
from echoloom.operators import issues


@dataclass(frozen=True)
class Filter:
    """Empty parameters do not filter. Dates are inclusive UTC days, YYYY-MM-DD."""

    start: str = ""
    end: str = ""
    source: str = ""
    category: str = ""
    issue: str = ""
    review: bool = False
    q: str = ""


def filter_feedback(df: DataFrame, f: Filter, groups: DataFrame = None) -> DataFrame:
    """Day bounds are compared as instants, so they reach the scan as range filters.

    An issue key is looked up once in the issue list (`groups`, or counted here) and
    filters as plain equalities.
    """
    names = issues.names_of(issues.issue_groups(df) if groups is None else groups, f.issue) if f.issue else None
    if f.start:
        df = df.where(F.col("timestamp") >= _midnight(f.start))
    if f.end:
        after = dt.date.fromisoformat(f.end) + dt.timedelta(days=1)
        df = df.where(F.col("timestamp") < _midnight(after.isoformat()))
    if f.source:
        df = df.where(F.col("source") == f.source)
    if f.category:
        df = df.where(F.col("category") == f.category)
    if f.issue:
        df = df.where(issues.of_issue(*names))
    if f.review:
        df = df.where(labels.web_review_flag())
    return search(df, f.q) if f.q else df


def _midnight(day: str) -> Column:
    return F.lit(f"{day}T00:00:00Z").cast("timestamp")


def search(df: DataFrame, q: str) -> DataFrame:
    return df.where(search_match(q))


def order_evidence(df: DataFrame) -> DataFrame:
    return df.orderBy(F.col("timestamp").desc(), "source", "feedback_id")


def page(df: DataFrame, number: int, size: int = 25) -> DataFrame:
    """Page `number`, clamped to the pages there are; its days are found by counts before any sort."""
    days = df.groupBy(F.to_date("timestamp").alias("day")).agg(F.count("*").alias("n"))
    order = W.orderBy(F.col("day").desc())              # one row per day reaches the window
    days = days.withColumn("before", F.sum("n").over(order) - F.col("n"))
    total = days.agg(F.sum("n")).first()[0] or 0 if number > 1 else size
    skip = (min(max(1, number), max(1, -(-total // size))) - 1) * size
    # only the days that the page touches are sorted
    touched = days.where((F.col("before") < skip + size) & (F.col("before") + F.col("n") > skip)).agg(
        F.min("day").alias("first"), F.max("day").alias("last"), F.min("before").alias("before"),
        F.max(F.col("day").isNull()).alias("open")).first()
    if touched["before"] is None:
        return df.limit(0)
    day = F.to_date("timestamp")
    inside = F.lit(False)
    if touched["first"] is not None:
        after = touched["last"] + dt.timedelta(days=1)
        inside = (F.col("timestamp") >= _midnight(touched["first"].isoformat())) & (F.col("timestamp") < _midnight(after.isoformat()))
    if touched["open"]:
        inside = F.coalesce(inside, F.lit(False)) | day.isNull()
    return order_evidence(df.where(inside)).offset(skip - touched["before"]).limit(size)


def page_after(df: DataFrame, last=None, size: int = 25) -> DataFrame:
    """The page after the row with sort key `last` = (timestamp, source, feedback_id).

    Costs the same at any depth: rows up to `last` are filtered, not sorted and skipped.
    """
    if last is not None:
        time, source, feedback_id = (F.lit(v) for v in last)
        ts, s, i = F.col("timestamp"), F.col("source"), F.col("feedback_id")
        df = df.where((ts <= time) & ((ts < time) | (s > source)
                                      | ((s == source) & (i > feedback_id))))
    return order_evidence(df).limit(size)


def overview(rows: DataFrame) -> DataFrame:
    """Messages, reporters, issue types, actionable messages and messages to review."""
    name = F.when(F.col("issue_type") != "", F.col("issue_type"))
    user = F.when(web_trim("user_id") != "", F.struct("source", "user_id"))
    issue = F.when(name.isNotNull(), F.struct(F.coalesce("issue_cat", "category"), name))
    small = rows.select(user.alias("reporter"), issue.alias("issue"),
                        labels.web_review_flag().cast("int").alias("review"))
    # one aggregation per distinct count: together they would expand every row
    reporters = small.select("reporter").where("reporter IS NOT NULL").distinct().agg(
        F.count("*").alias("reporters"))
    types = small.groupBy("issue").agg(F.count("*").alias("n"), F.sum("review").alias("review")).agg(
        _total(F.col("n")).alias("messages"), F.count("issue").alias("issue_types"),
        _total(F.when(F.col("issue").isNotNull(), F.col("n"))).alias("actionable_messages"),
        _total(F.col("review")).alias("needs_review"))
    # two rows, laid over each other
    return types.unionByName(reporters, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("messages", "reporters", "issue_types", "actionable_messages", "needs_review")])


def _total(col: Column) -> Column:
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")


def weekly_sentiment(rows: DataFrame) -> DataFrame:
    """Messages per Monday week and sentiment; weeks without messages are zero."""
    week = F.to_date(F.date_trunc("week", "timestamp"))
    counts = rows.groupBy(week.alias("week")).agg(
        *[F.count(F.when(F.col("sentiment") == s, 1)).alias(s) for s in S.SENTIMENTS])
    spine = counts.agg(F.min("week").alias("a"), F.max("week").alias("b")).where("a is not null") \
        .select(F.explode(F.sequence("a", "b", F.make_dt_interval(days=F.lit(7)))).alias("week"))
    return spine.join(counts, "week", "left").select(
        "week", *[F.coalesce(s, F.lit(0)).alias(s) for s in S.SENTIMENTS])


def sentiment_totals(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("sentiment").isin(S.SENTIMENTS)).groupBy("sentiment") \
        .agg(F.count("*").alias("messages"))


def category_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("category").agg(F.count("*").alias("messages")) \
        .orderBy(F.col("messages").desc(), "category")


def facets(rows: DataFrame) -> DataFrame:
    """Date bounds and the categories present, for a filter form: one row per category."""
    per = rows.groupBy("category").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    # At most one row per category reaches the window.
    every = W.partitionBy()
    return per.select("category", F.to_date(F.min("a").over(every)).alias("first_day"),
                      F.to_date(F.max("b").over(every)).alias("last_day"))


def dashboard_rows(df: DataFrame) -> DataFrame:
    """Row-level evidence for a dashboard."""
    review = labels.review_flag()
    user = F.when(F.col("user_id").isNull() | (F.trim("user_id") == ""), None).otherwise(
        F.to_json(F.struct("source", "user_id")))
    return df.select(
        "source", "feedback_id", "user_id", "message_text", "timestamp", "category", "issue_cat",
        "issue_type", "sentiment", "confidence_score", "explanation", "uncertain_classification",
        user.alias("source_user_key"), review.cast("int").alias("needs_review"),
        F.when(review, "Needs review").otherwise("Not flagged").alias("review_status"))


def display(df: DataFrame) -> DataFrame:
    return df.select("source", "feedback_id", labels.source_label().alias("source_label"),
                     labels.nice("category").alias("category_label"),
                     labels.nice("sentiment").alias("sentiment_label"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A few labelled messages in a stable order."""
    return df.orderBy("source", "feedback_id").limit(n)
