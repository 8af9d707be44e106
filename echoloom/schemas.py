"""Table schemas and closed vocabularies."""

from pyspark.sql import types as T

_S, _I, _D, _B, _L, _TS = (T.StringType(), T.IntegerType(), T.DoubleType(),
                           T.BooleanType(), T.LongType(), T.TimestampType())


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


def _strings(*names):
    return _struct(*[(n, _S) for n in names])


KEYS = ["source", "feedback_id"]
BASE_FIELDS = [("source", _S), ("feedback_id", _S), ("user_id", _S), ("message_text", _S),
               ("rating", _I), ("timestamp", _TS), ("app_version", _S), ("metadata", _S)]
LABEL_FIELDS = [("category", _S), ("confidence_score", _D), ("explanation", _S),
                ("sentiment", _S), ("uncertain_classification", _B)]
ISSUE_FIELDS = [("issue_cat", _S), ("issue_type", _S)]

BASE = [n for n, _ in BASE_FIELDS]
LABELS = [n for n, _ in LABEL_FIELDS]
ISSUES = [n for n, _ in ISSUE_FIELDS]

CLEAN = _struct(*BASE_FIELDS)
ANALYZED = _struct(*BASE_FIELDS, *LABEL_FIELDS)
GROUPED = _struct(*BASE_FIELDS, *LABEL_FIELDS, *ISSUE_FIELDS)
EXAMPLE = _struct(("message", _S), ("user", _S), ("source", _S), ("confidence", _D),
                  ("sentiment", _S), ("timestamp", _TS))
SUMMARY = _struct(("issue_category", _S), ("issue_type", _S), ("total_messages", _L),
                  ("unique_users", _L), ("avg_confidence", _D), ("uncertain_messages", _L),
                  ("first_reported", _TS), ("last_reported", _TS),
                  ("example_messages", T.ArrayType(EXAMPLE)),
                  ("messages_per_user", _D), ("needs_review", _B))
EVIDENCE = _struct(("issue_category", _S), ("issue_type", _S), ("day", T.DateType()), ("part", _L),
                   ("parts", _L), ("messages", _L), ("example_messages", T.ArrayType(EXAMPLE)))
# Parts of the summary that a run renews for the rows it touches only.
TOTALS = _struct(*ISSUE_FIELDS, ("messages", _L), ("score", _D), ("scored", _L), ("flagged", _L),
                 ("first", _TS), ("last", _TS))
NEWEST = _struct(*[f for f in BASE_FIELDS if f[0] in (*KEYS, "user_id", "message_text", "timestamp")],
                 ("confidence_score", _D), ("sentiment", _S), *ISSUE_FIELDS)
USERS = _struct(*ISSUE_FIELDS, ("source", _S), ("user_id", _S), ("messages", _L))
REPORTERS = _struct(*ISSUE_FIELDS, ("reporters", _L))

# Tables in buckets by feedback key, tables in buckets by user, and the summary.
BY_KEY = {"feedback_clean": CLEAN, "feedback_analyzed": ANALYZED, "feedback_with_issue_type": GROUPED,
          "issue_evidence": EVIDENCE, "issue_parts": TOTALS, "issue_newest": NEWEST}
BY_USER = {"issue_users": USERS, "issue_reporters": REPORTERS}
PUBLISHED = {**BY_KEY, **BY_USER, "issue_summary": SUMMARY}

AI_CACHE = _struct(("_cache_key", _S), ("classification_json", _S), ("sentiment", _S),
                   ("classified_at", _TS))
AI_RESPONSE = ("response ARRAY<STRUCT<value:STRING,confidence_score:DOUBLE,rationale:STRING>>, "
               "error_message STRING")
RUN_LOG = _struct(("run_id", _S), ("step", _S), ("status", _S), ("report", _S),
                  ("recorded_at", _TS))
DECISIONS = _struct(("issue_key", _S), ("status", _S), ("priority", _S), ("owner", _S),
                    ("note", _S), ("decided_at", _TS))
SUBMISSIONS = _struct(("id", _S), ("message_text", _S), ("rating", _I), ("created_by", _S),
                      ("created_at", _TS), ("run_id", _L), ("attempt", _I),
                      ("dispatch_error", _S), ("result", _S), ("completed_at", _TS))

# Raw exports: every value is text and is cast by the projectors.
RAW_APP_STORE = _strings("id", "nickname", "title", "body", "rating", "date", "version", "country")
RAW_GOOGLE_PLAY = _strings("reviewId", "userName", "content", "score", "at", "appVersion",
                           "thumbsUpCount")
RAW_IN_APP = _strings("uid", "msg", "ts", "app_version", "device", "screen")
RAW_SUPPORT = _strings("ticket_id", "customer_email", "subject", "message", "created_at",
                       "status", "channel")

# Fixed vocabularies.
CATEGORIES = ["PRAISE", "COMPLAINT_DELIVERY", "COMPLAINT_APP", "COMPLAINT_SUPPORT", "COMPLAINT_PRICING",
              "FEATURE_REQUEST", "QUESTION", "BUG_REPORT", "UNCLEAR"]
ACTIONABLE = ["BUG_REPORT", "FEATURE_REQUEST", "COMPLAINT_DELIVERY", "COMPLAINT_PRICING",
              "COMPLAINT_SUPPORT", "COMPLAINT_APP"]
SENTIMENTS = ["positive", "negative", "neutral", "mixed"]
SOURCE_LABELS = {"app_submission": "Customer submission", "app_store": "App Store",
                 "google_play": "Google Play", "in_app": "In-app", "support": "Support"}
STATUSES = ["approved", "rejected", "needs_info"]
PRIORITIES = ["P0", "P1", "P2", "P3"]
REVIEW_BELOW = 0.7
