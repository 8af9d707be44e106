"""Gates, filters and joins."""

from pyspark.sql import functions as F

from checks.base import (CACHE_KEY, FLAG, contact, inlist, issue_key, label_columns, listing, new_store,
                         phrase, q, query, stamp)
from checks.tables import ROW, _cache, _keyed, _pending, previous_store, slim
from echoloom import schemas as S
from echoloom.functions import identity
from echoloom.operators import (ai, decisions as D, explore, gates as G, incremental as I, issues)
from echoloom.operators.explore import Filter
from echoloom.sources import exports as X, samples as Z

BIG = "CAST(coalesce(sum(CAST({} AS INT)), 0) AS BIGINT)"


@query("gate_malformed_ratings", f"""SELECT count(*) AS checked_rows,
  {BIG.format("NOT coalesce(regexp_full_match(score, '\\s*[0-9]+\\s*'), false)")} AS malformed
  FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN o_orderpriority ELSE substr(o_orderpriority, 1, 1)
  END AS score FROM orders JOIN customer ON o_custkey = c_custkey)""")
def gate_malformed_ratings(spark, sf):
    """Pending orders export the whole priority text as their score."""
    raw = Z.google_play_raw(spark, sf).drop("score")
    orders = Z.table(spark, sf, "orders")
    score = F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")) \
        .otherwise(F.substring("o_orderpriority", 1, 1)).alias("score")
    scores = orders.select(F.col("o_orderkey").cast("string").alias("reviewId"), score)
    rows = X.normalize_google_play(raw.join(scores, "reviewId"))
    return G.violations(rows, malformed=G.malformed_rating())


@query("gate_bad_records", f"""SELECT count(*) AS checked_rows,
  {BIG.format('''("timestamp" IS NULL OR trim(message_text, ' ') = '' OR coalesce(rating NOT BETWEEN 1 AND 5, false))''')} AS bad
  FROM (SELECT try_strptime(CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%d/%m/%Y')
    ELSE strftime(o_orderdate, '%d/%m/%Y %H:%M') END, '%d/%m/%Y %H:%M') AS "timestamp",
    CASE WHEN o_orderpriority = '5-LOW' THEN '  ' ELSE o_orderpriority END AS message_text,
    CAST(floor(o_totalprice / 100000) AS INT) AS rating FROM orders)""")
def gate_bad_records(spark, sf):
    """Open orders carry a date without time, low priorities no text, big orders a high rating."""
    at = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy")) \
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm"))
    rows = Z.table(spark, sf, "orders").select(
        F.try_to_timestamp(at, F.lit("dd/MM/yyyy HH:mm")).alias("timestamp"),
        F.when(F.col("o_orderpriority") == "5-LOW", "  ").otherwise(F.col("o_orderpriority"))
        .alias("message_text"), F.floor(F.col("o_totalprice") / 100000).cast("int").alias("rating"))
    return G.violations(rows, bad=G.bad_record())


def _line_tickets(spark, sf):
    """One ticket per order line number: lines that share a key may differ."""
    return X.canonical(Z.table(spark, sf, "lineitem").select(
        F.lit("support").alias("source"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("feedback_id"),
        F.col("l_suppkey").alias("user_id"), Z.phrase(F.col("l_orderkey")).alias("message_text"),
        F.col("l_linenumber").alias("rating"), F.col("l_shipdate").alias("timestamp"),
        F.col("l_linestatus").alias("app_version"), F.col("l_returnflag").alias("metadata")))


LINE_TICKETS = f"""(SELECT 'support' AS source, l_orderkey || '-' || l_linenumber AS feedback_id,
  l_suppkey, {phrase('l_orderkey')} AS message_text, l_linenumber, l_shipdate, l_linestatus,
  l_returnflag FROM lineitem)"""


@query("gate_conflicting_payloads", f"""SELECT source, feedback_id, count(*) AS versions
  FROM (SELECT DISTINCT * FROM {LINE_TICKETS}) GROUP BY ALL HAVING count(*) > 1""")
def gate_conflicting_payloads(spark, sf):
    return G.conflicting_payloads(_line_tickets(spark, sf))


@query("duplicate_keys", f"""SELECT source, feedback_id, count(*) AS copies FROM {LINE_TICKETS}
  GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys(spark, sf):
    return G.duplicate_keys(_line_tickets(spark, sf))


@query("gate_unique_keys", f"""SELECT CAST(sum(n) AS BIGINT) AS checked_rows, count(*) AS keys,
  count(CASE WHEN n > 1 THEN 1 END) AS duplicate_keys, CAST(0 AS BIGINT) AS empty_keys
  FROM (SELECT source, feedback_id, count(*) AS n FROM {LINE_TICKETS} GROUP BY ALL)""")
def gate_unique_keys(spark, sf):
    return G.unique_keys(_line_tickets(spark, sf))


@query("gate_privacy", f"""SELECT count(*) AS checked_rows,
  {BIG.format(contact('message_text') + ' OR ' + contact('user_id') + ' OR ' + contact('metadata'))} AS before_masking,
  CAST(0 AS BIGINT) AS after_masking FROM corpus""")
def gate_privacy(spark, sf):
    """Violations in the raw rows and in the stored, masked rows (none)."""
    raw = Z.spread(Z.corpus(spark, sf)).withColumn("masked", F.lit(False))
    both = raw.unionByName(Z.stored(spark, sf).withColumn("masked", F.lit(True)))
    return both.agg(F.count(F.when(~F.col("masked"), 1)).alias("checked_rows"),
                    F.count(F.when(~F.col("masked") & G.contact_left(), 1)).alias("before_masking"),
                    F.count(F.when(F.col("masked") & G.contact_left(), 1)).alias("after_masking"))


def _faulty(spark, sf):
    """Answers with an unknown label, an error, or a sentiment outside the vocabulary."""
    rows = ai.classify(_keyed(spark, sf))
    text = F.col("classification_json")
    return rows.withColumns({
        "classification_json": F.when(text.contains("PRAISE"), F.replace(text, F.lit("PRAISE"), F.lit("JOY")))
        .when(text.contains("QUESTION"), F.replace(text, F.lit('"error_message":null'),
                                                   F.lit('"error_message":"busy"')))
        .when(text.contains("COMPLAINT_APP"), F.lit("{broken")).otherwise(text),
        "sentiment": F.when(text.contains("UNCLEAR"), "unknown").otherwise(F.col("sentiment"))})


@query("gate_ai_response", f"""SELECT _cache_key, category NOT IN
  ('PRAISE', 'QUESTION', 'COMPLAINT_APP', 'UNCLEAR') AS valid
  FROM (SELECT {CACHE_KEY} AS _cache_key, {label_columns()} FROM clean)""")
def gate_ai_response(spark, sf):
    return ai.parse_response(_faulty(spark, sf)).select("_cache_key", ai.response_ok().alias("valid"))


@query("gate_labels", """SELECT count(*) AS checked_rows, count(CASE WHEN category IN
  ('PRAISE', 'COMPLAINT_APP', 'UNCLEAR') THEN 1 END) AS invalid FROM analyzed""")
def gate_labels(spark, sf):
    return G.violations(ai.extract_labels(_faulty(spark, sf)), invalid=G.invalid_label())


@query("gate_row_preservation", """SELECT source, feedback_id FROM clean
  WHERE (source, feedback_id) NOT IN (SELECT (source, feedback_id) FROM old_clean)""")
def gate_row_preservation(spark, sf):
    """Rows of the load that the earlier result does not have."""
    return G.missing_rows(Z.stored(spark, sf), Z.previous_clean(spark, sf))


@query("gate_issue_membership", f"""SELECT count(*) AS checked_rows,
  count(CASE WHEN category = 'BUG_REPORT' AND sentiment = 'neutral' THEN 1 END) AS missing FROM grouped""")
def gate_issue_membership(spark, sf):
    """Neutral bug reports lose their issue here."""
    lost = (F.col("category") == "BUG_REPORT") & (F.col("sentiment") == "neutral")
    rows = Z.grouped(spark, sf).withColumn("issue_cat", F.when(~lost, F.col("issue_cat")))
    return G.violations(rows, missing=G.missing_membership())


@query("gate_summary_reconciles", """SELECT count(*) AS summary_messages, count(*) AS active_messages,
  true AS reconciles FROM active""")
def gate_summary_reconciles(spark, sf):
    rows = Z.grouped(spark, sf)
    return G.reconcile(issues.issue_totals(rows), issues.active(rows))


@query("gate_snapshot_fields", """SELECT count(*) AS checked_rows, count(*) AS keys,
  CAST(0 AS BIGINT) AS duplicate_keys, count(CASE WHEN sentiment = 'mixed' THEN 1 END) AS missing
  FROM grouped""")
def gate_snapshot_fields(spark, sf):
    """Mixed sentiments are blanked here."""
    mood = F.col("sentiment")
    rows = X.feedback_snapshot(Z.grouped(spark, sf).withColumn("sentiment", F.when(mood != "mixed", mood)))
    return G.key_violations(rows, missing=G.missing_snapshot_field())


@query("gate_baseline_unchanged", """SELECT 2 AS version, 'other' AS run_id,
  (SELECT count(*) FROM old_clean) AS rows, true AS refused""")
def gate_baseline_unchanged(spark, sf):
    """A run pinned before another publication may not publish."""
    from echoloom.plans.refresh import Refresh
    store = previous_store(spark, sf, "pinned")
    run = Refresh(store, "late")
    run.pin(1)
    run.save(store.read("feedback_with_issue_type"), "grouped")
    for name in S.PUBLISHED:
        store.write_version(name, store.read(name), "other")
    store.commit("other", 1)
    refused = False
    try:
        run.step("publish")
    except G.GateFailure as failure:
        refused = failure.gate == "baseline"
    head = store.head()
    return store.read("feedback_clean").agg(
        F.lit(int(head["version"])).alias("version"), F.lit(head["run_id"]).alias("run_id"),
        F.count("*").alias("rows"), F.lit(refused).alias("refused"))


@query("gate_cache_unique", f"""SELECT 2 * count(*) AS checked_rows, count(DISTINCT _cache_key) AS keys,
  2 * count(*) - count(DISTINCT _cache_key) AS duplicate_keys, CAST(0 AS BIGINT) AS empty_keys
  FROM (SELECT DISTINCT {CACHE_KEY} AS _cache_key FROM clean)""")
def gate_cache_unique(spark, sf):
    """Answers for the whole corpus, appended twice."""
    cache = Z.stored(spark, sf).select(identity.cache_key().alias("_cache_key")).distinct()
    return G.unique_keys(cache.unionByName(cache), ["_cache_key"])


@query("validate_submissions", """SELECT id, md5(message) AS message_md5, CAST(rating AS VARCHAR) AS rating,
  reason FROM checked_forms""")
def validate_submissions(spark, sf):
    rows = G.validate_submissions(Z.submission_forms(spark, sf))
    return rows.select("id", F.md5("message").alias("message_md5"), "rating", "reason")


@query("validate_decisions", f"""SELECT issue_key, status, priority, owner, note,
  {stamp('decided_at')}, reason FROM checked_decisions""")
def validate_decisions(spark, sf):
    return G.validate_decisions(Z.decision_forms(spark, sf))


# --- filters ---------------------------------------------------------------------------

PAYMENT = issue_key("'BUG'", "'Payment/Checkout Failure'")


@query("filter_feedback", f"""SELECT source, feedback_id, category, {stamp()} FROM grouped
  WHERE strftime("timestamp", '%Y-%m-%d') BETWEEN '1996-03-01' AND '2024-01-20'
    AND source = 'in_app' AND category = 'BUG_REPORT' AND {issue_key()} = {PAYMENT}
    AND contains(lower(message_text || ' ' || coalesce(explanation, '') || ' ' || feedback_id), 'phone')""")
def filter_feedback(spark, sf):
    key = spark.range(1).select(identity.issue_key(F.lit("BUG"), F.lit("Payment/Checkout Failure"))).first()[0]
    f = Filter(start="1996-03-01", end="2024-01-20", source="in_app", category="BUG_REPORT",
               issue=key, q="PHONE")
    return explore.filter_feedback(Z.grouped(spark, sf), f).select(
        "source", "feedback_id", "category", "timestamp")


@query("search_feedback", """SELECT source, feedback_id FROM grouped
  WHERE contains(lower(message_text || ' ' || coalesce(explanation, '') || ' ' || feedback_id), 'dark mode')""")
def search_feedback(spark, sf):
    return explore.search(Z.grouped(spark, sf), "Dark MODE").select("source", "feedback_id")


@query("active_messages", "SELECT source, feedback_id, issue_type FROM active")
def active_messages(spark, sf):
    return issues.active(Z.grouped(spark, sf)).select("source", "feedback_id", "issue_type")


GROUP_COLUMNS = "key, name, category, messages, reporters, repeated_reporters, review"


@query("problems_vs_features", f"""SELECT {GROUP_COLUMNS}, CASE WHEN category = 'FEATURE_REQUEST'
  THEN 'feature' ELSE 'problem' END AS kind FROM issue_groups""")
def problems_vs_features(spark, sf):
    groups = issues.issue_groups(Z.grouped(spark, sf))
    return issues.problems(groups).withColumn("kind", F.lit("problem")).unionByName(
        issues.features(groups).withColumn("kind", F.lit("feature")))


@query("issue_evidence", f"""SELECT source, feedback_id, user_id, {stamp()} FROM active
  WHERE {issue_key()} = {PAYMENT}""")
def issue_evidence(spark, sf):
    key = spark.range(1).select(identity.issue_key(F.lit("BUG"), F.lit("Payment/Checkout Failure"))).first()[0]
    return issues.evidence(Z.grouped(spark, sf), key).select("source", "feedback_id", "user_id", "timestamp")


# --- joins -----------------------------------------------------------------------------

LABEL_ROW = """category, confidence_score, explanation, sentiment, uncertain_classification"""


@query("reuse_unchanged_labels", f"SELECT {ROW}, {LABEL_ROW} FROM reused")
def reuse_unchanged_labels(spark, sf):
    return slim(I.reuse_labels(Z.stored(spark, sf), Z.previous_analyzed(spark, sf)), *S.LABELS)


@query("pending_rows", "SELECT source, feedback_id, _cache_key FROM pending")
def pending_rows(spark, sf):
    return _pending(spark, sf).select("source", "feedback_id", "_cache_key")


@query("uncached_rows", """SELECT source, feedback_id, _cache_key FROM pending
  WHERE _cache_key NOT IN (SELECT _cache_key FROM cached)""")
def uncached_rows(spark, sf):
    return I.uncached(_pending(spark, sf), _cache(spark, sf)).select("source", "feedback_id", "_cache_key")


@query("attach_cached_labels", """SELECT source, feedback_id, c.category, c.confidence_score,
  c.explanation, c.sentiment FROM pending p JOIN cached c ON p._cache_key = c._cache_key""")
def attach_cached_labels(spark, sf):
    rows = ai.extract_labels(I.attach(_pending(spark, sf), _cache(spark, sf)))
    return rows.select("source", "feedback_id", "category", "confidence_score", "explanation", "sentiment")


@query("retained_history", f"""SELECT {ROW} FROM old_clean
  WHERE (source, feedback_id) NOT IN (SELECT (source, feedback_id) FROM clean)""")
def retained_history(spark, sf):
    return slim(I.retained(Z.previous_clean(spark, sf), Z.stored(spark, sf)))


@query("restrict_to_incoming", f"""SELECT {ROW} FROM old_clean
  WHERE (source, feedback_id) IN (SELECT (source, feedback_id) FROM clean)""")
def restrict_to_incoming(spark, sf):
    return slim(I.restrict(Z.previous_clean(spark, sf), Z.stored(spark, sf)))


@query("union_retained", f"""SELECT {ROW} FROM (SELECT * FROM clean UNION ALL SELECT * FROM old_clean
  WHERE (source, feedback_id) NOT IN (SELECT (source, feedback_id) FROM clean))""")
def union_retained(spark, sf):
    return slim(I.union_retained(Z.stored(spark, sf), Z.previous_clean(spark, sf)))


@query("record_diff", """SELECT coalesce(a.source, b.source) AS source,
  coalesce(a.feedback_id, b.feedback_id) AS feedback_id,
  CASE WHEN a.source IS NULL THEN 'removed' WHEN b.source IS NULL THEN 'added' ELSE 'changed' END AS change
  FROM clean a FULL JOIN old_clean b ON a.source = b.source AND a.feedback_id = b.feedback_id
  WHERE a.source IS NULL OR b.source IS NULL OR (a.user_id, a.message_text, a.rating, a."timestamp",
    a.app_version, a.metadata) IS DISTINCT FROM
    (b.user_id, b.message_text, b.rating, b."timestamp", b.app_version, b.metadata)""")
def record_diff(spark, sf):
    return I.record_diff(Z.stored(spark, sf), Z.previous_clean(spark, sf), S.BASE)


@query("reuse_issue_groups", """SELECT a.source, a.feedback_id, a.category, o.issue_cat, o.issue_type
  FROM analyzed a JOIN old_grouped o ON a.source = o.source AND a.feedback_id = o.feedback_id
  AND a.message_text IS NOT DISTINCT FROM o.message_text AND a.category IS NOT DISTINCT FROM o.category""")
def reuse_issue_groups(spark, sf):
    return I.reuse_groups(Z.analyzed(spark, sf), Z.previous_grouped(spark, sf)).select(
        "source", "feedback_id", "category", "issue_cat", "issue_type")


@query("saved_decisions", f"""SELECT issue_key, status, priority, owner, note, {stamp('decided_at')},
  coalesce(name, 'Saved issue') AS issue_name FROM decisions LEFT JOIN issue_groups ON key = issue_key""")
def saved_decisions(spark, sf):
    return D.saved_decisions(Z.decisions(spark, sf), issues.issue_groups(Z.grouped(spark, sf)))


@query("issue_with_decision", f"""SELECT {GROUP_COLUMNS}, status, priority, owner, note,
  {stamp('decided_at')}, status IS NOT NULL AS has_decision
  FROM issue_groups LEFT JOIN decisions ON key = issue_key""")
def issue_with_decision(spark, sf):
    return D.issue_view(issues.issue_groups(Z.grouped(spark, sf)), Z.decisions(spark, sf))
