"""Event-time trends over a stream of labelled rows."""

from pyspark.sql import DataFrame, functions as F

from echoloom import schemas as S


def stream_weekly(rows: DataFrame, delay: str = "14 days") -> DataFrame:
    """Messages per Monday week and sentiment. For append mode: a week is emitted once, when the
    watermark (the newest time less `delay`) passes its end; later messages of it are left out and
    counted in the query's progress.

    The epoch was a Thursday: windows of seven days start four days later, on Mondays.
    """
    week = F.window("timestamp", "7 days", startTime="4 days")
    return rows.withWatermark("timestamp", delay).groupBy(week).agg(
        *[F.count(F.when(F.col("sentiment") == s, 1)).alias(s) for s in S.SENTIMENTS]) \
        .select(F.to_date("window.start").alias("week"), *S.SENTIMENTS)


def stream_weeks(rows: DataFrame) -> DataFrame:
    """Messages per Monday week and sentiment, of every week so far, open ones too. For complete or update mode.

    No message is left out: late ones count in their week, and those without a time in a week of their own, null.
    The state is one row of counts per week.
    """
    return rows.groupBy(F.to_date(F.date_trunc("week", "timestamp")).alias("week")).agg(
        *[F.count(F.when(F.col("sentiment") == s, 1)).alias(s) for s in S.SENTIMENTS])
