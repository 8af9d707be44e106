import datetime as dt
import hashlib
import json
import re

from pyspark.sql import functions as F

from echoloom import schemas as S
from echoloom.functions import identity, labels, rules as R
from echoloom.operators import ai, issues
from echoloom.sources import exports as X, samples as Z


def plain_issue(category, text):
    for pattern, name in R.ISSUE_RULES.get(category, []):
        if re.search(pattern, text, re.I | re.A):
            return name
    return R.ISSUE_FALLBACK.get(category, R.ISSUE_CONSTANT.get(category))


def test_every_rule_family_on_every_phrase(spark):
    texts = Z.PHRASES + ["LATE", "chocolate", "Build it", "multiple", "real time", "realtime", "real\ntime",
                         "4x", "version 4.", "PRE-ORDER", ""]
    rows = [(c, t) for c in [*S.CATEGORIES] for t in texts]
    df = labels.with_issue_type(spark.createDataFrame(rows, "category string, message_text string"))
    for r in df.withColumn("issue_cat", labels.issue_cat()).collect():
        want = plain_issue(r.category, r.message_text)
        assert r.issue_type == want, (r.category, r.message_text)
        assert r.issue_cat == (None if want is None else R.ISSUE_CATEGORY.get(r.category, r.category))


EXPECTED = [   # written out, so that a slip in a rule table shows
    ("BUG_REPORT", "The payment failed", "Payment/Checkout Failure"), ("BUG_REPORT", "It has crashed", "App Crash/Freeze"),
    ("BUG_REPORT", "No OTP came", "Login/Authentication"), ("BUG_REPORT", "Search is broken", "Search Functionality"),
    ("BUG_REPORT", "The button is broken", "Button/UI Not Working"), ("BUG_REPORT", "Broken since May", "Post-Update Issues"),
    ("BUG_REPORT", "Voucher error", "Promo Code Issues"), ("BUG_REPORT", "Billed twice", "Duplicate Charges"),
    ("BUG_REPORT", "It is broken", "Other Bug"), ("FEATURE_REQUEST", "Add a dark theme", "Dark Mode"),
    ("FEATURE_REQUEST", "Let us split bills: split bill", "Group/Split Orders"), ("FEATURE_REQUEST", "Order in advance", "Scheduled Orders"),
    ("FEATURE_REQUEST", "A bookmark list", "Favorites/Saved Items"), ("FEATURE_REQUEST", "Show a GPS dot", "Better Tracking"),
    ("FEATURE_REQUEST", "Send an alert", "Notifications/Alerts"), ("FEATURE_REQUEST", "Vegan dishes", "Dietary Filters"),
    ("FEATURE_REQUEST", "A gratuity", "Tipping Options"), ("FEATURE_REQUEST", "A new logo", "UI/Design Changes"),
    ("FEATURE_REQUEST", "Add PayPal", "Payment Methods"), ("FEATURE_REQUEST", "More", "Other Feature Request"),
    ("COMPLAINT_DELIVERY", "It was late and cold", "Late Delivery"), ("COMPLAINT_DELIVERY", "Cold soup", "Food Temperature"),
    ("COMPLAINT_DELIVERY", "A mistake", "Wrong Order"), ("COMPLAINT_DELIVERY", "Forgot the rice", "Missing Items"),
    ("COMPLAINT_DELIVERY", "It never came", "Order Cancelled/No Show"), ("COMPLAINT_DELIVERY", "Rude driver", "Driver/Location Issues"),
    ("COMPLAINT_DELIVERY", "A spill", "Damaged Food"), ("COMPLAINT_DELIVERY", "Bad", "Other Delivery Issue"),
    ("COMPLAINT_PRICING", "x", "Pricing/Fees Too High"), ("COMPLAINT_SUPPORT", "x", "Customer Support Issues"),
    ("COMPLAINT_APP", "x", "App Performance"), ("PRAISE", "The payment failed", None), ("QUESTION", "x", None)]


def test_issue_of_each_text(spark):
    df = spark.createDataFrame([(i, c, t) for i, (c, t, _) in enumerate(EXPECTED)], "i int, category string, message_text string")
    got = {r.i: r.issue_type for r in labels.with_issue_type(df).collect()}
    assert [(t, got[i]) for i, (_, t, _) in enumerate(EXPECTED)] == [(t, want) for _, t, want in EXPECTED]


def test_rules_are_ordered(spark):
    df = spark.createDataFrame([("BUG_REPORT", "promo code"), ("BUG_REPORT", "card charged twice")],
                               "category string, message_text string")
    assert [r.issue_type for r in labels.with_issue_type(df).collect()] == [
        "Login/Authentication", "Payment/Checkout Failure"]


def test_batch_model_equals_expression(spark):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(Z.PHRASES + ["", None])],
                               "_cache_key string, message_text string")
    a = ai.keyword_scores(df).orderBy("_cache_key").collect()
    b = ai.score(df, ai.keyword_model()).orderBy("_cache_key").collect()
    assert a == b
    assert {r.value for r in a} == set(S.CATEGORIES)


def test_review_flags(spark):
    nan = float("nan")
    rows = [(0.8, "x", False), (0.69, "x", False), (None, "x", False), (0.8, " ", False),
            (0.8, "x", True), (nan, "x", False), (0.8, "\t", False), (0.8, None, None)]
    df = spark.createDataFrame(rows, "confidence_score double, explanation string, uncertain_classification boolean")
    got = df.select(labels.review_flag().alias("a"), labels.web_review_flag().alias("b")).collect()
    assert [r.a for r in got] == [False, True, True, True, True, False, False, True]
    assert [r.b for r in got] == [False, True, True, True, True, False, True, True]


def test_parse_and_split_responses(spark):
    good = '{"response":[{"value":"PRAISE","confidence_score":0.9,"rationale":"ok"}]}'
    rows = [("1", good, "positive"), ("2", good, "angry"), ("3", "{", "neutral"),
            ("4", good.replace("0.9", "1.5"), "neutral"), ("5", good.replace("PRAISE", "X"), "neutral"),
            ("6", '{"response":[],"error_message":"busy"}', "neutral"), ("7", good.replace('"ok"', '" "'), "mixed")]
    df = spark.createDataFrame([(*r, None) for r in rows], S.AI_CACHE)
    valid, failed = ai.split_responses(df)
    assert [r._cache_key for r in valid.collect()] == ["1"]
    assert sorted(r._cache_key for r in failed.collect()) == ["2", "3", "4", "5", "6", "7"]
    assert ai.extract_labels(valid).first().category == "PRAISE"


def test_keys(spark, feedback):
    df = feedback(("support", 'i"1', "alice", "Payment fails", None, "2026-09-10T23:59:00")) \
        .withColumns({"issue_cat": F.lit("BUG"), "issue_type": F.lit("Checkout"), "category": F.lit("BUG_REPORT")})
    row = df.select(identity.row_issue_key().alias("k"), identity.reporter_key().alias("r")).first()
    want = hashlib.sha256(json.dumps(["BUG", "Checkout"], separators=(",", ":")).encode()).hexdigest()[:24]
    assert row.k == f"issue-{want}" and row.r == '["support","alice"]'


def test_in_app_identity(spark):
    rows = [("u1", "great", "t1"), ("u1", "broken", "t1"), ("u1", "great", "t2"), ("u1", "great", "t1")]
    raw = spark.createDataFrame([(*r, None, None, None) for r in rows], S.RAW_IN_APP)
    ids = [r.feedback_id for r in X.normalize_in_app(raw).collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[3] == hashlib.md5(b"u1|great|t1").hexdigest()


def test_projections(spark):
    play = spark.createDataFrame([("1", "u", "c", "5", "05/09/2026 07:03", "1", None),
                                  ("2", "u", "c", "x", "5/9/2026 7:03", "1", "3")], S.RAW_GOOGLE_PLAY)
    a, b = X.normalize_google_play(play).collect()
    assert a.timestamp == dt.datetime(2026, 9, 5, 7, 3) and a.metadata == "thumbsUp:"
    assert b.timestamp is None and b.rating is None and b.metadata == "thumbsUp:|3"
    ticket = spark.createDataFrame([("T", "a@b.c", None, "m", "1781510249000", "open", "email")], S.RAW_SUPPORT)
    r = X.normalize_support(ticket).first()
    assert r.metadata == "status:|open|channel:|email" and r.message_text == "m"
    assert r.user_id == "user_" + hashlib.sha256(b"a@b.c").hexdigest()
    assert X.normalize_support(ticket, digits=8).first().user_id == "user_" + hashlib.sha256(b"a@b.c").hexdigest()[:8]


def test_issue_counts_messages_and_reporters(spark, feedback):
    rows = feedback(("support", "1", "alice", "a", None, "2026-09-10T23:59:00"),
                    ("support", "2", "alice", "b", None, "2026-09-10T23:59:00"),
                    ("google_play", "1", "alice", "c", None, "2026-09-10T23:59:00"),
                    ("support", "3", None, "d", None, "2026-09-12T23:59:00")).withColumns(
        {"category": F.lit("BUG_REPORT"), "sentiment": F.lit("negative"), "confidence_score": F.lit(0.8),
         "explanation": F.lit("x"), "uncertain_classification": F.lit(False),
         "issue_type": F.lit("Checkout"), "issue_cat": F.lit("BUG")})
    g = issues.issue_groups(rows).first()
    assert (g.messages, g.reporters, g.repeated_reporters, g.review) == (4, 2, 1, 0)
    s = issues.issue_summary(rows, newest=3).first()
    assert (s.total_messages, s.unique_users, s.messages_per_user, s.needs_review) == (4, 2, 2.0, False)
    assert [e.message for e in s.example_messages] == ["d", "c", "a"]
    chunks = issues.issue_examples(rows, per_row=2).collect()
    assert sorted(e.message for c in chunks for e in c.example_messages) == ["a", "b", "c", "d"]
    assert issues.distinct_reporters(rows).first()[0] == 2
