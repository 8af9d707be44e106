"""Whole refresh runs and streams."""

from pyspark.sql import functions as F

from checks.base import (CTES, FLAG, ISSUE_CAT, four, issue_type_case, label_columns, labelled, masked_rows,
                         new_store, query, stamp)
from checks.reports import NEWEST, RATE_LIMIT, SUMMARY, WEEKS, sample_sql
from checks.tables import ROW, previous_store, published, slim
from echoloom import schemas as S
from echoloom.operators import ai, issues, submissions as U
from echoloom.plans.evaluate import evaluate
from echoloom.plans.refresh import Refresh
from echoloom.plans.submissions import submission_refresh
from echoloom.session import scratch
from echoloom.sources import exports as X, samples as Z
from echoloom.streaming.submissions import stream_dedup, stream_rate_limit, stream_refresh
from echoloom.streaming.trends import stream_weeks

# The load holds every review once per order line; orders without lines are not in it.
CTES.update({
    "load": masked_rows("(SELECT DISTINCT * FROM (" + four("raw_app", "raw_play_copies", "raw_in", "raw_sup") + "))"),
    "prepared": """SELECT a.*, CASE WHEN b.source IS NULL THEN 'new'
      WHEN (a.user_id, a.message_text, a.rating, a."timestamp", a.app_version, a.metadata)
        IS DISTINCT FROM (b.user_id, b.message_text, b.rating, b."timestamp", b.app_version, b.metadata)
      THEN 'changed' ELSE 'same' END AS status
      FROM load a LEFT JOIN old_clean b ON a.source = b.source AND a.feedback_id = b.feedback_id
      UNION ALL SELECT o.*, 'retained' FROM old_clean o
      WHERE (source, feedback_id) NOT IN (SELECT (source, feedback_id) FROM load)""",
    "final_analyzed": f"""SELECT p.* EXCLUDE (status), a.category, a.confidence_score, a.explanation,
      a.sentiment, (a.uncertain_classification OR a.confidence_score < 0.7 OR trim(a.explanation) = '')
        AS uncertain_classification FROM prepared p JOIN old_analyzed a
      ON p.source = a.source AND p.feedback_id = a.feedback_id AND p.message_text = a.message_text
      UNION ALL {labelled('''(SELECT * EXCLUDE (status) FROM prepared p WHERE NOT EXISTS (
        SELECT 1 FROM old_analyzed a WHERE p.source = a.source AND p.feedback_id = a.feedback_id
        AND p.message_text = a.message_text))''')}""",
    "final_grouped": f"""SELECT * EXCLUDE (fresh_type, old_type, old_cat, hit),
      CASE WHEN hit THEN old_type ELSE fresh_type END AS issue_type,
      CASE WHEN hit THEN old_cat WHEN category = 'BUG_REPORT' THEN 'BUG'
        WHEN fresh_type IS NOT NULL THEN category END AS issue_cat FROM (
      SELECT f.*, {issue_type_case('f.category', 'f.message_text')} AS fresh_type,
        o.issue_type AS old_type, o.issue_cat AS old_cat, o.source IS NOT NULL AS hit
      FROM final_analyzed f LEFT JOIN old_grouped o ON f.source = o.source
        AND f.feedback_id = o.feedback_id AND f.message_text = o.message_text AND f.category = o.category)""",
})
FINAL = f"""source, feedback_id, user_id, md5(message_text) AS text_md5, CAST(rating AS VARCHAR) AS rating,
  {stamp()}, app_version, metadata"""


def _load(spark, sf):
    return X.unify_exports(**Z.raw_exports(spark, sf, reexported=True))


def _run(spark, sf, name, *steps):
    """A run over the published earlier load, up to and including the given steps."""
    run = Refresh(previous_store(spark, sf, name), "42")
    for step in steps:
        run.step(step, *([_load(spark, sf)] if step == "prepare" else []))
    return run


@query("prepare_result", f"SELECT {FINAL}, status FROM prepared")
def prepare_result(spark, sf):
    run = _run(spark, sf, "prepare", "prepare")
    return slim(run.stage("prepared"), F.col("_status").alias("status"))


@query("analyze_result", f"""SELECT {FINAL}, category, confidence_score, explanation, sentiment,
  uncertain_classification FROM final_analyzed""")
def analyze_result(spark, sf):
    return slim(_run(spark, sf, "analyze", "prepare", "analyze").stage("analyzed"), *S.LABELS)


@query("group_result", "SELECT source, feedback_id, category, issue_cat, issue_type FROM final_grouped")
def group_result(spark, sf):
    run = _run(spark, sf, "group", "prepare", "analyze", "group")
    return run.stage("grouped").select("source", "feedback_id", "category", *S.ISSUES)


@query("publish_result", f"""SELECT {FINAL}, category, sentiment, issue_cat, issue_type,
  2 AS version FROM final_grouped""")
def publish_result(spark, sf):
    """The published rows after the whole run, and the version readers see."""
    store = _run(spark, sf, "publish", "prepare", "analyze", "group", "publish").store
    return slim(store.read("feedback_with_issue_type"), "category", "sentiment", *S.ISSUES,
                F.lit(int(store.head()["version"])).alias("version"))


def _count(condition, alias):
    return f"count(CASE WHEN {condition} THEN 1 END) AS {alias}"


@query("refresh_metrics", f"""SELECT (SELECT count(*) FROM ({four('raw_app', 'raw_play_copies', 'raw_in', 'raw_sup')}))
    AS input_rows, {_count("status IN ('new', 'changed')", 'processed')}, {_count("status = 'same'", 'skipped')},
  {_count("status = 'retained'", 'retained')}, count(*) AS total,
  (SELECT count(*) FROM final_analyzed WHERE uncertain_classification) AS needs_review,
  (SELECT count(*) FROM prepared p WHERE NOT EXISTS (SELECT 1 FROM old_analyzed a WHERE p.source = a.source
     AND p.feedback_id = a.feedback_id AND p.message_text = a.message_text)) AS ai_messages,
  (SELECT count(*) FROM final_grouped WHERE issue_type IS NOT NULL) AS actionable_messages FROM prepared""")
def refresh_metrics(spark, sf):
    run = _run(spark, sf, "metrics", "prepare", "analyze", "group")
    counts = {**{k: "prepare" for k in ("input_rows", "processed", "skipped", "total")},
              "needs_review": "analyze", "ai_messages": "analyze", "actionable_messages": "group"}
    values = {k: run.metrics[step][k] for k, step in counts.items()}
    values["retained"] = run.metrics["prepare"]["retained_from_previous"]
    return run.store.reports().where("step = 'prepare'").select(
        *[F.lit(int(v)).cast("bigint").alias(k) for k, v in values.items()])


@query("incremental_rerun", """SELECT count(*) AS total, CAST(0 AS BIGINT) AS ai_messages,
  CAST(0 AS BIGINT) AS prepared_changes, CAST(0 AS BIGINT) AS published_changes FROM prepared""")
def incremental_rerun(spark, sf):
    """The same load again: nothing is labelled, nothing changes."""
    store = previous_store(spark, sf, "rerun")
    Refresh(store, "1").run(_load(spark, sf))
    again = Refresh(store, "2").run(_load(spark, sf))
    values = {"ai_messages": again["analyze"]["ai_messages"],
              "prepared_changes": again["prepare"]["processed"],
              "published_changes": again["publish"]["processed"]}
    return store.read("feedback_with_issue_type").agg(
        F.count("*").alias("total"), *[F.lit(v).cast("bigint").alias(k) for k, v in values.items()])


@query("incremental_summary", f"""SELECT {SUMMARY}, shown, newest_md5 FROM issue_totals t JOIN (
  SELECT issue_cat AS c, issue_type AS i, count(*) AS shown,
    md5(string_agg(message_text, chr(10) ORDER BY rank)) AS newest_md5
  FROM ({NEWEST}) WHERE rank <= {issues.NEWEST} GROUP BY ALL) s ON t.issue_category = s.c AND t.issue_type = s.i""")
def incremental_summary(spark, sf):
    """All exports but one customer's tickets, then these alone: the second run renews the buckets they fall into."""
    store = new_store(spark, "parts").bootstrap()
    exports = Z.raw_exports(spark, sf)
    late = F.col("customer_email") == "user7@mail.example.com"
    tickets = exports["support"]
    Refresh(store, "1").run(X.unify_exports(**exports | {"support": tickets.where(~late)}))
    Refresh(store, "2").run(X.unify(X.normalize_support(tickets.where(late))))
    return store.read("issue_summary").withColumns({
        "shown": F.size("example_messages").cast("bigint"),
        "newest_md5": F.md5(F.array_join(F.col("example_messages.message"), "\n"))}).drop("example_messages")


SUB_GROUPED = f"""(SELECT *, {ISSUE_CAT} AS issue_cat FROM (SELECT *, {issue_type_case()} AS issue_type
  FROM ({labelled('(' + masked_rows('sub_rows') + ')')})))"""
RECEIPT = f"""SELECT feedback_id AS id, category, sentiment, issue_type, CAST(rating AS VARCHAR) AS rating,
  uncertain_classification FROM {SUB_GROUPED}"""
RECEIPT_FIELDS = ("category STRING, sentiment STRING, issue_type STRING, rating INT, "
                  "uncertain_classification BOOLEAN")


def _receipt_rows(done):
    return done.select("id", F.from_json("result", RECEIPT_FIELDS).alias("r")).select("id", "r.*")


@query("submission_refresh", RECEIPT)
def submission_refresh_query(spark, sf):
    """All saved submissions through the four steps; one receipt each."""
    run = Refresh(previous_store(spark, sf, "submit"), "7")
    return _receipt_rows(submission_refresh(run, Z.submissions(spark, sf)))


JUDGED = f"""SELECT *, {label_columns()} FROM (SELECT o.category AS old_category, o.sentiment AS old_sentiment,
  o.explanation AS old_explanation, coalesce(c.message_text, o.message_text) AS message_text
  FROM ({sample_sql("old_grouped", 1000)}) o LEFT JOIN clean c ON o.source = c.source AND o.feedback_id = c.feedback_id)"""


@query("quality_evaluation", f"""SELECT scorer, count(*) AS judged, count(CASE WHEN passed THEN 1 END) AS passed,
  round(avg(CAST(passed AS INT)), 6) AS pass_rate FROM (
  SELECT 'category_supported' AS scorer, old_category = category AS passed FROM ({JUDGED}) UNION ALL
  SELECT 'sentiment_supported', old_sentiment = sentiment FROM ({JUDGED}) UNION ALL
  SELECT 'explanation_grounded', old_explanation = explanation FROM ({JUDGED})) GROUP BY scorer""")
def quality_evaluation(spark, sf):
    """Labels of the earlier load, at its version, against today's texts: some texts changed."""
    return evaluate(published(spark, sf), 1, Z.stored(spark, sf), n=1000)


@query("ai_audit_log", f"""SELECT source, feedback_id, md5(message_text) AS text_md5, sentiment
  FROM (SELECT *, {label_columns()} FROM load)""")
def ai_audit_log(spark, sf):
    """Masked inputs next to the answers, for a first run over empty tables."""
    run = Refresh(new_store(spark, "audit").bootstrap(), "1", audit=True)
    run.step("prepare", _load(spark, sf))
    run.step("analyze")
    return run.stage("ai_audit").select("source", "feedback_id", F.md5("message_text").alias("text_md5"),
                                        "sentiment")


# --- streams ---------------------------------------------------------------------------

PER_BATCH = 1_500_000   # posts of a micro-batch, which are in the state at once


def _drain(stream):
    stream.awaitTermination()


@query("stream_refresh", RECEIPT)
def stream_refresh_query(spark, sf):
    """The submission stream through refresh runs; receipts of all batches."""
    store = new_store(spark, "stream").bootstrap()
    events = Z.stream(spark, sf, "events", "ts")
    _drain(stream_refresh(Z.submissions_from(events), store, scratch(spark, "ckpt")))
    return _receipt_rows(spark.read.parquet(f"{store.root}/stage/run=stream-*/receipts"))


@query("stream_dedup", """SELECT id, strftime(min(created_at), '%Y-%m-%d %H:%M:%S.%f') AS accepted_at,
  min_by(payload, (created_at, payload)) AS payload, count(*) AS attempts,
  min(payload) <> max(payload) AS conflict FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY id ORDER BY created_at ROWS UNBOUNDED PRECEDING) AS life FROM (
      SELECT *, CASE WHEN created_at <= lag(created_at) OVER (PARTITION BY id ORDER BY created_at) + INTERVAL 7 DAY
          THEN 0 ELSE 1 END AS fresh,
        sha256(CAST(to_json({'created_by': created_by, 'message': message, 'rating': rating}) AS VARCHAR)) AS payload
      FROM attempts)) GROUP BY id, life
  HAVING max(created_at) + INTERVAL 8 DAY <= (SELECT max(created_at) FROM attempts)""")
def stream_dedup_query(spark, sf):
    """The IDs that closed by the end of the stream: none for seven days before the watermark, a day behind."""
    return _appended(spark, stream_dedup(Z.attempts_from(Z.stream(spark, sf, "lineitem", "l_shipdate", per_batch=PER_BATCH))))


def _appended(spark, closed):
    """What a stream in append mode has written after all input."""
    path = scratch(spark, "closed")
    _drain(closed.writeStream.format("parquet").option("path", path).outputMode("append")
           .option("checkpointLocation", scratch(spark, "ckpt")).trigger(availableNow=True).start())
    return spark.read.schema(closed.schema).parquet(path)


@query("stream_rate_limit", RATE_LIMIT)
def stream_rate_limit_query(spark, sf):
    path = scratch(spark, "limit")
    events = Z.stream(spark, sf, "events", "ts")
    subs = events.select(F.col("event_id").cast("string").alias("id"),
                         F.concat(F.lit("actor_"), F.col("event_type")).alias("created_by"),
                         F.col("ts").alias("created_at"))
    _drain(stream_rate_limit(subs, path, scratch(spark, "ckpt"), limit=4))
    return spark.read.parquet(path).drop("late")


@query("stream_weekly_sentiment", f"""SELECT CAST(CAST(date_trunc('week', "timestamp") AS DATE) AS VARCHAR) AS week,
  {WEEKS} FROM ({labelled('(' + masked_rows('sub_rows') + ')')}) GROUP BY 1""")
def stream_weekly_query(spark, sf):
    """Weekly sentiment of the submission stream, all weeks, in complete mode."""
    from echoloom.functions.text import mask
    rows = Z.label(mask(X.read_submissions(Z.submissions_from(Z.stream(spark, sf, "events", "ts")))))
    path = scratch(spark, "weekly")

    def keep(batch, batch_id):
        batch.write.mode("overwrite").parquet(path)     # a row per week

    weeks = stream_weeks(rows)
    _drain(weeks.writeStream.outputMode("complete").foreachBatch(keep)
           .option("checkpointLocation", scratch(spark, "ckpt")).trigger(availableNow=True).start())
    return spark.read.schema(weeks.schema).parquet(path)
