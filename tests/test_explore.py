import datetime as dt

from pyspark.sql import functions as F

from echoloom.functions import identity
from echoloom.operators import decisions as D, explore, quality as Q
from echoloom.operators.explore import Filter


def labelled(df, **over):
    cols = {"category": "BUG_REPORT", "sentiment": "negative", "confidence_score": 0.8, "explanation": "Payment error",
            "uncertain_classification": False, "issue_type": "Checkout", "issue_cat": "BUG"} | over
    return df.withColumns({k: v if not isinstance(v, (str, float, bool)) else F.lit(v) for k, v in cols.items()})


def test_filters_compose_and_include_the_end_day(spark, feedback):
    late = "2026-09-10T23:59:00"
    rows = labelled(feedback(("support", "1", "a", "Payment fails", None, late), ("in_app", "1", "a", "Payment fails", None, late),
                             ("support", "2", "a", "Payment fails", None, "2026-09-11T00:00:00"),
                             ("support", "3", "a", "Payment fails", None, late)),
                    issue_type=F.when(F.col("feedback_id") == "3", "Login").otherwise("Checkout"))
    key = spark.range(1).select(identity.issue_key(F.lit("BUG"), F.lit("Checkout"))).first()[0]
    f = Filter(issue=key, source="support", start="2026-09-10", end="2026-09-10", q="PAYMENT")
    assert [r.feedback_id for r in explore.filter_feedback(rows, f).collect()] == ["1"]
    assert explore.filter_feedback(rows, Filter(issue="unknown")).count() == 0
    assert explore.filter_feedback(rows, Filter(review=True)).count() == 0
    assert explore.search(rows, "%").count() == 0        # literal, not a pattern


def test_search_reads_the_whole_query(spark, feedback):
    rows = feedback(("support", "1", "u", "x" * 200 + "A", None, "2026-01-01")).withColumn("explanation", F.lit(""))
    assert explore.search(rows, "x" * 200 + "a").count() == 1 and explore.search(rows, "x" * 200 + "b").count() == 0


def test_pages(spark, feedback):
    rows = feedback(*[("s", f"{i:02d}", "u", "x", 1, dt.datetime(2026, 1, 1) + dt.timedelta(hours=i // 2)) for i in range(60)])
    last = explore.page(rows, 99).collect()
    assert len(last) == 10 and explore.page(rows, 0).count() == 25
    first = explore.page(rows, 1).collect()
    end = first[-1]
    after = explore.page_after(rows, (end.timestamp, end.source, end.feedback_id)).collect()
    assert after == explore.page(rows, 2).collect()
    assert explore.page(rows.limit(0), 3).count() == 0


def test_weeks_without_messages_are_zero(spark, feedback):
    rows = labelled(feedback(("s", "1", "u", "x", 1, "2026-01-04T23:00:00"), ("s", "2", "u", "x", 1, "2026-01-19")),
                    sentiment=F.when(F.col("feedback_id") == "2", "odd").otherwise("mixed"))
    got = [(str(r.week), r.mixed, r.positive) for r in explore.weekly_sentiment(rows).orderBy("week").collect()]
    assert got == [("2025-12-29", 1, 0), ("2026-01-05", 0, 0), ("2026-01-12", 0, 0), ("2026-01-19", 0, 0)]


def test_overview(feedback):
    rows = labelled(feedback(("s", "1", "u", "x", 1, "2026-01-01"), ("s", "2", " ", "x", 1, "2026-01-01"),
                             ("t", "1", "u", "x", 1, "2026-01-01")),
                    issue_type=F.when(F.col("source") == "s", "A"))
    assert explore.overview(rows).first().asDict() == {"messages": 3, "reporters": 2, "issue_types": 1,
                                                       "actionable_messages": 2, "needs_review": 0}
    assert explore.overview(rows.limit(0)).first().messages == 0


def test_decisions(spark):
    schema = "issue_key string, status string, priority string, owner string, note string, decided_at timestamp"
    t = dt.datetime(2026, 1, 1)
    old = spark.createDataFrame([("issue-a", "approved", None, None, None, t), ("issue-z", "rejected", None, None, None, t)], schema)
    new = spark.createDataFrame([("issue-a", "rejected", "P1", None, None, t + dt.timedelta(1)),
                                 ("issue-a", "needs_info", "P2", None, None, t + dt.timedelta(2)),
                                 ("issue-x", "approved", None, None, None, t)], schema)
    groups = spark.createDataFrame([("issue-a", "Checkout")], "key string, name string")
    after = D.apply_decisions(old, new, groups)
    assert {r.issue_key: r.status for r in after.collect()} == {"issue-a": "needs_info", "issue-z": "rejected"}
    assert [(r.issue_key, r.issue_name) for r in D.saved_decisions(after, groups).collect()] == [
        ("issue-a", "Checkout"), ("issue-z", "Saved issue")]


def test_sample_prefers_submissions_and_varies(spark, feedback):
    rows = labelled(feedback(*[("support", str(i), "u", "x", 1, "2026-01-01") for i in range(200)],
                             ("app_submission", "s", "u", "x", 1, "2026-01-01")),
                    category=F.when(F.col("feedback_id") < "5", "PRAISE").otherwise("QUESTION"))
    sample = Q.quality_sample(rows).collect()
    assert len(sample) == 20 and sample[0].source == "app_submission"
    assert {r.category for r in sample} == {"PRAISE", "QUESTION"} and sum(r.category == "PRAISE" for r in sample) == 10
