"""Registry of queries with their DuckDB twins, and the SQL the twins share."""

import re

from pyspark.sql import DataFrame, functions as F

from echoloom import schemas as S
from echoloom.functions import rules as R
from echoloom.functions.labels import word_pattern
from echoloom.session import configure, scratch
from echoloom.sources import samples as Z
from echoloom.tables import Store

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    """Register a query; `sql` may use the shared tables of CTES by name."""
    def register(fn):
        def run(spark, sf_dir):
            return plain(fn(configure(spark), sf_dir))
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn
    return register


def new_store(spark, name) -> Store:
    return Store(spark, scratch(spark, name))


def plain(df: DataFrame) -> DataFrame:
    """Times as text and nullable integers as text, so both engines compare by value."""
    out = []
    for f in df.schema:
        kind = f.dataType.typeName()
        col = F.col(f"`{f.name}`")
        if kind == "timestamp":
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "date" or f.name == "rating":
            col = col.cast("string")
        elif kind == "double":
            col = F.round(col, 6)
        out.append(col.alias(f.name))
    return df.select(*out)


# --- SQL side --------------------------------------------------------------------------

def q(text):
    return "'" + text.replace("'", "''") + "'"


def listing(items):
    return "[" + ", ".join(q(i) for i in items) + "]"


def inlist(items):
    return "(" + ", ".join(q(i) for i in items) + ")"


def stamp(col="timestamp", alias=None):
    col_sql = f'"{col}"' if re.fullmatch(r"\w+", col) else col
    return f"strftime({col_sql}, '%Y-%m-%d %H:%M:%S.%f') AS \"{alias or col}\""


def phrase(key, shift=0):
    return f"({listing(Z.PHRASES)})[1 + ({key} + {shift}) % {len(Z.PHRASES)}]"


def masked(col):
    return (f"regexp_replace(regexp_replace(regexp_replace({col}, {q(R.EMAIL)}, {q(R.EMAIL_TOKEN)}, 'g'), "
            f"{q(R.UK_PHONE)}, {q(R.PHONE_TOKEN)}, 'g'), {q(R.INTL_PHONE)}, {q(R.PHONE_TOKEN)}, 'g')")


def contact(col):
    return f"coalesce(regexp_matches({col}, {q(R.EMAIL + '|' + R.UK_PHONE + '|' + R.INTL_PHONE)}), false)"


def matches(col, pattern):
    return f"regexp_matches({col}, {q('(?i)(' + pattern + ')')})"


def case_label(col, pick):
    whens = " ".join(f"WHEN {matches(col, r[0])} THEN {pick(r[1:])}" for r in R.CATEGORY_RULES)
    return f"CASE {whens} ELSE {pick(R.CATEGORY_DEFAULT)} END"


def label_columns(col="message_text"):
    good, bad = (matches(col, word_pattern(w)) for w in (R.POSITIVE_WORDS, R.NEGATIVE_WORDS))
    return f"""{case_label(col, lambda r: q(r[0]))} AS category,
      {case_label(col, lambda r: str(r[1]))}::DOUBLE AS confidence_score,
      {case_label(col, lambda r: q(r[2]))} AS explanation,
      CASE WHEN {good} AND {bad} THEN 'mixed' WHEN {good} THEN 'positive'
           WHEN {bad} THEN 'negative' ELSE 'neutral' END AS sentiment"""


def issue_type_case(cat="category", col="message_text"):
    out = []
    for category, rules in R.ISSUE_RULES.items():
        inner = " ".join(f"WHEN {matches(col, p)} THEN {q(n)}" for p, n in rules)
        out.append(f"WHEN {cat} = {q(category)} THEN CASE {inner} "
                   f"ELSE {q(R.ISSUE_FALLBACK[category])} END")
    out += [f"WHEN {cat} = {q(c)} THEN {q(n)}" for c, n in R.ISSUE_CONSTANT.items()]
    return "CASE " + " ".join(out) + " END"


ISSUE_CAT = "CASE WHEN category = 'BUG_REPORT' THEN 'BUG' WHEN issue_type IS NOT NULL THEN category END"
FLAG = """(coalesce(uncertain_classification, false) OR confidence_score IS NULL
  OR coalesce(confidence_score < 0.7, false) OR explanation IS NULL OR trim(explanation, ' ') = '')"""
USER = "CASE WHEN trim(user_id, ' ') <> '' THEN user_id END"


def issue_key(cat="coalesce(issue_cat, category)", name="issue_type"):
    return f"'issue-' || substr(sha256(CAST(to_json([{cat}, {name}]) AS VARCHAR)), 1, 24)"


def uuid(text):
    return (f"substr(md5({text}),1,8) || '-' || substr(md5({text}),9,4) || '-4' || "
            f"substr(md5({text}),14,3) || '-8' || substr(md5({text}),18,3) || '-' || substr(md5({text}),21,12)")


def fingerprint(cols):
    pairs = ", ".join(f"{q(c)}: {c}" for c in cols)
    return "sha256(CAST(to_json({" + pairs + "}) AS VARCHAR))"


CACHE_KEY = (f"sha256({fingerprint(['source', 'feedback_id', 'message_text'])} || '|' || "
             f"{q(R.CLASSIFIER_VERSION)})")
ISSUE_PAIRS = [(R.ISSUE_CATEGORY.get(c, c), n) for c, rules in R.ISSUE_RULES.items() for _, n in rules]


def issue_pick(key):
    at = f"[1 + {key} % {len(ISSUE_PAIRS)}]"
    return (f"({listing([c for c, _ in ISSUE_PAIRS])}){at}",
            f"({listing([n for _, n in ISSUE_PAIRS])}){at}")


def play(orders, text):
    return f"""SELECT CAST(o_orderkey AS VARCHAR) AS "reviewId", c_name AS "userName",
      {text} AS content, substr(o_orderpriority, 1, 1) AS score,
      strftime(o_orderdate, '%d/%m/%Y %H:%M') AS "at", '4.' || c_nationkey AS "appVersion",
      CAST(c_nationkey AS VARCHAR) AS "thumbsUpCount"
      FROM {orders} JOIN customer ON o_custkey = c_custkey"""


def order_text(shift=0):
    return f"{phrase('o_orderkey', shift)} || ' Order ' || o_orderkey || '.'"


def norm_app(t):
    return f"""SELECT 'app_store' AS source, id AS feedback_id, nickname AS user_id,
      concat_ws(' - ', title, body) AS message_text, try_cast(rating AS INT) AS rating,
      try_cast(date AS TIMESTAMP) AS "timestamp", version AS app_version,
      concat_ws('|', 'country:', country) AS metadata FROM {t}"""


def norm_play(t):
    return f"""SELECT 'google_play' AS source, "reviewId" AS feedback_id, "userName" AS user_id,
      content AS message_text, try_cast(score AS INT) AS rating,
      try_strptime("at", '%d/%m/%Y %H:%M') AS "timestamp", "appVersion" AS app_version,
      concat_ws('|', 'thumbsUp:', "thumbsUpCount") AS metadata FROM {t}"""


def norm_in(t):
    return f"""SELECT 'in_app' AS source, md5(concat_ws('|', uid, msg, ts)) AS feedback_id,
      uid AS user_id, msg AS message_text, CAST(NULL AS INT) AS rating,
      try_cast(ts AS TIMESTAMP) AS "timestamp", app_version,
      concat_ws('|', 'device:', device, 'screen:', screen) AS metadata FROM {t}"""


def norm_sup(t):
    return f"""SELECT 'support' AS source, ticket_id AS feedback_id,
      'user_' || sha256(customer_email) AS user_id,
      concat_ws(' - ', subject, message) AS message_text, CAST(NULL AS INT) AS rating,
      epoch_ms(CAST(created_at AS BIGINT)) AS "timestamp", CAST(NULL AS VARCHAR) AS app_version,
      concat_ws('|', 'status:', status, 'channel:', channel) AS metadata FROM {t}"""


def in_app_select(device, where=""):
    return f"""SELECT CAST(user_id AS VARCHAR) AS uid,
      {phrase('event_id')} || ' Session ' || user_id || '.' AS msg,
      strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CAST(NULL AS VARCHAR) AS app_version,
      {device} AS device, props AS screen FROM events {where}"""


def masked_rows(t):
    return f"""SELECT source, feedback_id, {masked('user_id')} AS user_id,
      {masked('message_text')} AS message_text, rating, "timestamp", app_version,
      {masked('metadata')} AS metadata FROM {t}"""


def labelled(t):
    return f"""SELECT * EXCLUDE (uncertain_classification), {FLAG} AS uncertain_classification
      FROM (SELECT *, {label_columns()}, false AS uncertain_classification FROM {t})"""


def grouped_rows(t, issue_type):
    return f"""SELECT *, {ISSUE_CAT} AS issue_cat FROM (SELECT *, {issue_type} AS issue_type FROM {t})"""


def four(app, play_, in_, sup):
    return " UNION ALL ".join([norm_app(app), norm_play(play_), norm_in(in_), norm_sup(sup)])


_FORMS_MESSAGE = "trim(message, %s)" % ("' ' || " + " || ".join(
    f"chr({ord(c)})" for c in R.WEB_BLANKS if c != " "))

CTES = {
    "raw_app": """SELECT CAST(doc_id AS VARCHAR) AS id, 'reader_' || (doc_id % 50) AS nickname,
      source AS title, text AS body, CAST(doc_id % 5 + 1 AS VARCHAR) AS rating,
      strftime(TIMESTAMP '2024-01-01' + to_minutes(doc_id % 500000), '%Y-%m-%d %H:%M:%S') AS date,
      CAST(NULL AS VARCHAR) AS version, lang AS country FROM documents""",
    "raw_play": play("orders", order_text()),
    "raw_play_copies": play("orders JOIN lineitem ON l_orderkey = o_orderkey", order_text()),
    "raw_in": in_app_select("event_type"),
    "raw_sup": """SELECT conv_id || '-' || turn AS ticket_id,
      'user' || conv_id || '@mail.example.com' AS customer_email, role AS subject, text AS message,
      CAST(1704067200000 + conv_id * 3600000 + turn * 60000 AS VARCHAR) AS created_at,
      CASE WHEN turn = 0 THEN 'open' ELSE 'pending' END AS status, role AS channel
      FROM conversations""",
    "corpus": four("raw_app", "raw_play", "raw_in", "raw_sup"),
    "clean": masked_rows("corpus"),
    "analyzed": labelled("clean"),
    "grouped": grouped_rows("analyzed", issue_type_case()),
    "old_app": """SELECT * FROM raw_app WHERE country <> 'de' UNION ALL
      SELECT 'page-' || page_id, NULL, url, html, '3', '2023-12-01 00:00:00', NULL, NULL FROM pages""",
    "old_play": play("(SELECT * FROM orders WHERE o_orderstatus <> 'O')",
                     f"CASE WHEN o_orderstatus = 'P' THEN {order_text(1)} ELSE {order_text()} END"),
    "old_in": in_app_select("CASE WHEN event_type <> 'error' THEN event_type END",
                            "WHERE event_type <> 'signup'"),
    "old_clean": masked_rows("(" + four("old_app", "old_play", "old_in", "raw_sup") + ")"),
    "old_analyzed": f"SELECT * REPLACE ('Saved earlier.' AS explanation) FROM ({labelled('old_clean')})",
    "old_grouped": f"""SELECT * REPLACE (CASE WHEN category = 'COMPLAINT_DELIVERY'
      THEN 'Delivery (reviewed)' ELSE issue_type END AS issue_type)
      FROM ({grouped_rows('old_analyzed', issue_type_case())})""",
    "active": "SELECT * FROM grouped WHERE issue_type IS NOT NULL",
    "issue_totals": f"""SELECT issue_cat AS issue_category, issue_type, count(*) AS total_messages,
      count(DISTINCT CASE WHEN trim(user_id, ' ') <> '' THEN (source, user_id) END) AS unique_users,
      avg(confidence_score) AS avg_confidence,
      CAST(sum(CAST(uncertain_classification AS INT)) AS BIGINT) AS uncertain_messages,
      min("timestamp") AS first_reported, max("timestamp") AS last_reported
      FROM active GROUP BY ALL""",
    "issue_groups": f"""SELECT {issue_key('category', 'name')} AS key, name, category,
      CAST(sum(n) AS BIGINT) AS messages, count(usr) AS reporters,
      count(CASE WHEN usr IS NOT NULL AND n > 1 THEN 1 END) AS repeated_reporters,
      CAST(sum(review) AS BIGINT) AS review FROM (
        SELECT coalesce(issue_cat, category) AS category, issue_type AS name, source,
          {USER} AS usr, count(*) AS n, sum(CAST({FLAG} AS INT)) AS review
        FROM active GROUP BY ALL) GROUP BY category, name""",
    "reused": """SELECT p.*, a.category, a.confidence_score, a.explanation, a.sentiment,
      a.uncertain_classification FROM clean p JOIN old_analyzed a
      ON p.source = a.source AND p.feedback_id = a.feedback_id
      AND p.message_text IS NOT DISTINCT FROM a.message_text""",
    "pending": f"""SELECT c.*, {CACHE_KEY} AS _cache_key FROM clean c
      WHERE (source, feedback_id) NOT IN (SELECT (source, feedback_id) FROM reused)""",
    # Responses of the baseline's texts, as an earlier run would have cached them.
    "cached": f"""SELECT {CACHE_KEY} AS _cache_key, category, confidence_score, explanation, sentiment
      FROM analyzed WHERE source = 'in_app'""",
    "subs": f"""SELECT {uuid("'event ' || event_id")} AS id,
      {phrase('event_id')} || ' Sent by ' || user_id AS message_text,
      CAST(event_id % 5 + 1 AS INT) AS rating, 'user_' || user_id AS created_by, ts AS created_at,
      CASE WHEN event_type <> 'signup' THEN event_id END AS run_id, 0 AS attempt,
      CASE WHEN event_type = 'signup' THEN 'Not started.' END AS dispatch_error,
      CASE WHEN event_type = 'purchase' THEN '{{"run_id":' || event_id || '}}' END AS result,
      event_type FROM events""",
    "sub_rows": """SELECT 'app_submission' AS source, id AS feedback_id,
      'customer_' || id AS user_id, message_text, rating, created_at AS "timestamp",
      'demo' AS app_version, 'submitted via app' AS metadata FROM subs""",
    "attempts": f"""SELECT {uuid("'line ' || l_orderkey || '/' || l_linenumber")} AS id,
      'actor_' || l_returnflag AS created_by, {phrase('l_orderkey')} AS message,
      CAST(l_quantity AS INT) % 2 + 1 AS rating, l_shipdate AS created_at FROM lineitem""",
    "forms": f"""SELECT upper({uuid("'event ' || event_id")}) AS id,
      ' ' || chr(9) || {phrase('event_id')} || ' ' || chr(10) AS message,
      CAST(event_id % 7 AS INT) AS rating FROM events UNION ALL
      SELECT CASE WHEN lang = 'fr' THEN 'doc-' || doc_id ELSE {uuid("'document ' || doc_id")} END,
      CASE WHEN lang = 'es' THEN chr(1) || text ELSE text END, NULL FROM documents""",
    "checked_forms": f"""SELECT lower(id) AS id, m AS message, rating,
      CASE WHEN NOT regexp_matches(id, {q(R.UUID_V4)}) THEN 'invalid id'
        WHEN length(m) < 10 OR length(m) > 2000 THEN 'message length'
        WHEN regexp_matches(m, {q(R.CONTROL_CHARS)}) THEN 'control characters'
        WHEN rating NOT BETWEEN 1 AND 5 THEN 'rating' END AS reason
      FROM (SELECT *, {_FORMS_MESSAGE} AS m FROM forms)""",
    "decision_forms": f"""SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Not a key!' ELSE ' ' ||
      {issue_key(*issue_pick('c_custkey'))} END AS issue_key,
      (['approved', 'rejected', 'needs_info', 'maybe'])[1 + c_custkey % 4] AS status,
      (['P0', 'P1', 'P2', 'P3', 'P9', ''])[1 + c_custkey % 6] AS priority,
      CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE ' ' || repeat(c_name, 6) END AS owner,
      chr(9) || repeat(c_mktsegment, 60) || ' ' AS note,
      TIMESTAMP '2024-01-01' + to_minutes(c_custkey % 500000) AS decided_at FROM customer""",
    "checked_decisions": f"""SELECT trim(issue_key) AS issue_key, status,
      CASE WHEN priority IN ('P0','P1','P2','P3') THEN priority END AS priority,
      nullif(trim(owner), '') AS owner,
      nullif(trim(note, ' ' || chr(9)), '') AS note, decided_at,
      CASE WHEN NOT regexp_matches(trim(issue_key), '{R.DECISION_KEY}') THEN 'issue key'
        WHEN status NOT IN ('approved', 'rejected', 'needs_info') THEN 'status' END AS reason
      FROM decision_forms""",
    "decisions": f"""SELECT issue_key, 'approved' AS status, 'P2' AS priority,
      max_by(s_name, (decided_at, s_name)) AS owner, CAST(NULL AS VARCHAR) AS note,
      max(decided_at) AS decided_at FROM (
        SELECT *, CASE WHEN s_nationkey = 0 THEN {issue_key("'OLD'", "s_name")}
          ELSE {issue_key(*issue_pick('s_suppkey'))} END AS issue_key,
          TIMESTAMP '2024-01-01' + to_minutes(s_suppkey % 500000) AS decided_at FROM supplier)
      GROUP BY issue_key""",
    "new_decisions": """SELECT f.* EXCLUDE (reason, rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY issue_key ORDER BY decided_at DESC, status DESC) AS rn
        FROM checked_decisions WHERE reason IS NULL) f
      WHERE rn = 1 AND issue_key IN (SELECT key FROM issue_groups)""",
}


def with_ctes(sql):
    """Prefix the CTEs a statement needs, in dependency order."""
    order = []

    def visit(text):
        for name in CTES:
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+\(*{name}\b", text):
                visit(CTES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql
    body = ",\n".join(f"{name} AS ({CTES[name]})" for name in order)
    return f"WITH {body}\n{sql}"
