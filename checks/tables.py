"""Sources, sinks and projections."""

import json

from pyspark.sql import functions as F

from checks.base import (CACHE_KEY, FLAG, ISSUE_CAT, USER, contact, fingerprint, inlist, issue_key,
                         issue_type_case, label_columns, masked, new_store, norm_app, norm_in,
                         norm_play, norm_sup, q, query, stamp)
from echoloom import schemas as S
from echoloom.functions import identity, labels
from echoloom.functions.text import mask
from echoloom.operators import ai, decisions as D, explore, incremental as I, issues, submissions as U
from echoloom.plans.refresh import Refresh
from echoloom.session import scratch
from echoloom.sources import exports as X, samples as Z

ROW = f"""source, feedback_id, user_id, md5(message_text) AS text_md5, CAST(rating AS VARCHAR) AS rating,
  {stamp()}, app_version, metadata"""


def slim(df, *extra):
    """Canonical columns, the text as a hash."""
    return df.select("source", "feedback_id", "user_id", F.md5("message_text").alias("text_md5"),
                     "rating", "timestamp", "app_version", "metadata", *extra)


_published = {}


def published(spark, sf):
    """A store holding what the load before published; written once per session."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _published:
        store = new_store(spark, "published").bootstrap()
        rows = Z.previous_grouped(spark, sf)
        there = store.bucket_folders(Z.saved_at(spark, sf, "previous"))
        whole = [there.get(b, "") for b in range(store.buckets)]
        folders = {"issue_summary": store.write_version("issue_summary", issues.issue_summary(rows, issues.NEWEST), "previous"),
                   "issue_evidence": store.write_version("issue_evidence", issues.issue_examples(
                       rows, keep=lambda p: store.save_stage(p, "previous", "large_days")), "previous"),
                   **dict.fromkeys(("feedback_clean", "feedback_analyzed", "feedback_with_issue_type"), whole)}
        store.commit("previous", 0, store.head()["folders"] | folders, cut=store.cut)
        _published[key] = store
    return _published[key]


def previous_store(spark, sf, name):
    """A store of its own that starts from the published earlier load."""
    return new_store(spark, name).start_from(published(spark, sf))


# --- sources ---------------------------------------------------------------------------

@query("scan_csv_export", f"SELECT {ROW} FROM ({norm_app('raw_app')})")
def scan_csv_export(spark, sf):
    """App-store reviews written as header CSV (quoted line breaks and all) and read back."""
    path = scratch(spark, "csv")
    Z.app_store_raw(spark, sf).write.options(header=True, escape='"').csv(path)
    return slim(X.normalize_app_store(X.read_csv_export(spark, path, S.RAW_APP_STORE)))


@query("scan_json_export", f"SELECT {ROW} FROM ({norm_in('raw_in')})")
def scan_json_export(spark, sf):
    """In-app messages as JSON lines."""
    path = scratch(spark, "json")
    Z.in_app_raw(spark, sf).write.json(path)
    return slim(X.normalize_in_app(X.read_json_export(spark, path, S.RAW_IN_APP, lines=True)))


@query("scan_json_array", f"SELECT {ROW} FROM ({norm_in('raw_in')})")
def scan_json_array(spark, sf):
    """In-app messages as files of one JSON array each."""
    path = scratch(spark, "array")
    Z.in_app_raw(spark, sf).groupBy(F.pmod(F.xxhash64("msg", "ts"), F.lit(64)).alias("part")).agg(
        F.to_json(F.collect_list(F.struct(*S.RAW_IN_APP.names))).alias("value")) \
        .repartition(64, "part").write.partitionBy("part").text(path)
    rows = X.read_json_export(spark, f"{path}/*", S.RAW_IN_APP)
    return slim(X.normalize_in_app(rows))


@query("load_raw_table", """SELECT "reviewId", "userName", md5(content) AS content_md5, CAST(score AS INT) AS score, "at",
  CAST("appVersion" AS DOUBLE) AS "appVersion", CAST("thumbsUpCount" AS VARCHAR) AS "thumbsUpCount" FROM raw_play""")
def load_raw_table(spark, sf):
    """Exploratory load with inferred types, row by row: score and version come back as numbers."""
    path = scratch(spark, "raw")
    Z.google_play_raw(spark, sf).write.options(header=True, escape='"').csv(path)
    text = [F.col(c).cast("string").alias(c) for c in ("reviewId", "userName", "at", "thumbsUpCount")]
    return X.load_raw(spark, path, "csv").select(*text, "appVersion", F.md5("content").alias("content_md5"),
                                                 F.col("score").cast("int").alias("score"))


@query("load_raw_rescued", """SELECT "reviewId", CAST(score AS INT) AS score, CAST(NULL AS INT) AS "appVersion",
  "appVersion" AS rescued_version, CASE WHEN length("thumbsUpCount") > 1 THEN "thumbsUpCount" END AS rescued_thumbs,
  length("thumbsUpCount") <= 1 AS thumbs_kept FROM raw_play""")
def load_raw_rescued(spark, sf):
    """Named types that do not fit: versions are no integers, nor are the larger counts, written with a sign here."""
    path = scratch(spark, "rescued")
    Z.google_play_raw(spark, sf).withColumn(
        "thumbsUpCount", F.when(F.length("thumbsUpCount") > 1, F.concat(F.lit("~"), "thumbsUpCount")).otherwise(F.col("thumbsUpCount"))) \
        .write.options(header=True, escape='"').csv(path)
    rows = X.load_raw(spark, path, "csv", types={"appVersion": "int", "thumbsUpCount": "int"})
    return rows.select(F.col("reviewId").cast("string").alias("reviewId"), F.col("score").cast("int").alias("score"), "appVersion",
                       F.col("_rescued")["appVersion"].alias("rescued_version"),
                       F.ltrim(F.col("_rescued")["thumbsUpCount"], F.lit("~")).alias("rescued_thumbs"),
                       F.col("thumbsUpCount").isNotNull().alias("thumbs_kept"))


@query("source_row_counts", "SELECT source, count(*) AS rows FROM corpus GROUP BY source")
def source_row_counts(spark, sf):
    return X.source_counts(Z.corpus(spark, sf))


@query("pinned_snapshot_read", f"""SELECT {ROW} FROM old_clean""")
def pinned_snapshot_read(spark, sf):
    """Version 1 stays readable after version 2 is published."""
    store = new_store(spark, "pin").bootstrap()
    store.write_version("feedback_clean", Z.previous_clean(spark, sf), "one")
    store.commit("one", 0, store.head()["folders"] | {"feedback_clean": store._path("feedback_clean", "one")})
    store.write_version("feedback_clean", Z.clean(spark, sf), "two")
    store.commit("two", 1, store.head()["folders"] | {"feedback_clean": store._path("feedback_clean", "two")})
    return slim(store.read("feedback_clean", 1))


@query("submission_source", f"""SELECT source, feedback_id, user_id, md5(message_text) AS text_md5,
  CAST(rating AS VARCHAR) AS rating, {stamp()}, app_version, metadata
  FROM sub_rows WHERE feedback_id IN (SELECT id FROM subs WHERE result IS NULL)""")
def submission_source(spark, sf):
    """Canonical rows of the submissions that have no result yet."""
    saved = Z.submissions(spark, sf)
    return slim(X.read_submissions(saved, saved.where("result is null")))


@query("feedback_snapshot", f"""SELECT source, feedback_id, user_id, md5(message_text) AS text_md5,
  {stamp()}, CAST(rating AS VARCHAR) AS rating, category, sentiment, confidence_score, explanation,
  uncertain_classification, issue_type, issue_cat FROM grouped""")
def feedback_snapshot(spark, sf):
    rows = X.feedback_snapshot(Z.grouped(spark, sf))
    return rows.withColumn("text_md5", F.md5("message_text")).drop("message_text")


# --- sinks -----------------------------------------------------------------------------

@query("stage_roundtrip", f"SELECT {ROW} FROM clean")
def stage_roundtrip(spark, sf):
    return slim(new_store(spark, "stage").save_stage(Z.clean(spark, sf), "1", "clean"))


@query("upsert_merge", f"""SELECT {ROW} FROM (SELECT * FROM clean UNION ALL SELECT * FROM old_clean
  WHERE (source, feedback_id) NOT IN (SELECT (source, feedback_id) FROM clean))""")
def upsert_merge(spark, sf):
    return slim(I.upsert(Z.previous_clean(spark, sf), Z.stored(spark, sf), S.KEYS, S.BASE))


def _cache(spark, sf):
    """Cached answers for the in-app part of the corpus."""
    rows = Z.stored(spark, sf).where("source = 'in_app'").withColumn("_cache_key", identity.cache_key())
    return ai.classify(rows)


def _pending(spark, sf):
    return I.pending(Z.stored(spark, sf), Z.previous_analyzed(spark, sf))


@query("cache_insert_only", f"""SELECT _cache_key, sentiment FROM (
  SELECT _cache_key, sentiment FROM cached UNION ALL
  SELECT _cache_key, sentiment FROM (SELECT *, {label_columns()} FROM pending)
  WHERE _cache_key NOT IN (SELECT _cache_key FROM cached))""")
def cache_insert_only(spark, sf):
    """Answers for pending rows are inserted; answers that exist stay untouched."""
    cache = _cache(spark, sf)
    added = I.insert_missing(cache, ai.classify(_pending(spark, sf)), "_cache_key")
    return cache.unionByName(added).select("_cache_key", "sentiment")


@query("summary_overwrite", """SELECT issue_category, issue_type, total_messages, unique_users
  FROM issue_totals""")
def summary_overwrite(spark, sf):
    """The second summary replaces the first."""
    store = new_store(spark, "summary").bootstrap()
    rows = store.save_stage(Z.grouped(spark, sf), "1", "grouped")
    store.write_version("issue_summary", issues.issue_summary(rows.limit(0)), "1")
    path = store.write_version("issue_summary", issues.issue_summary(rows), "1")
    store.commit("1", 0, store.head()["folders"] | {"issue_summary": path})
    return store.read("issue_summary").select("issue_category", "issue_type", "total_messages",
                                              "unique_users")


@query("run_report_log", """SELECT '1' AS run_id, 'prepare' AS step, 'SUCCEEDED' AS status,
  (SELECT count(*) FROM corpus) AS input_rows, (SELECT count(*) FROM corpus) AS total""")
def run_report_log(spark, sf):
    """A report holds counts only."""
    run = Refresh(new_store(spark, "log").bootstrap(), "1")
    run.step("prepare", Z.corpus(spark, sf))
    report = F.from_json("report", "input_rows BIGINT, total BIGINT")
    return run.store.reports().select("run_id", "step", "status", report.alias("r")) \
        .select("run_id", "step", "status", "r.input_rows", "r.total")


@query("snapshot_clone", f"SELECT {ROW} FROM old_clean")
def snapshot_clone(spark, sf):
    source = published(spark, sf)
    copy = source.clone_to(new_store(spark, "copy"))
    try:
        source.clone_to(copy)
    except FileExistsError:
        return slim(copy.read("feedback_clean"))
    raise AssertionError("a second clone must fail")


def _submission_rows(spark, sf):
    rows = Z.label(mask(X.read_submissions(Z.submissions(spark, sf))))
    return issues.assign(rows)


@query("completion_receipt", f"""SELECT feedback_id AS id, category, issue_type, sentiment,
  CAST(rating AS VARCHAR) AS rating, 3 AS processed, 1 AS skipped, '7' AS run_id,
  CASE WHEN issue_type IS NOT NULL THEN {issue_key()} END AS issue_key
  FROM (SELECT *, {ISSUE_CAT} AS issue_cat FROM (SELECT *, {issue_type_case()} AS issue_type
    FROM (SELECT * EXCLUDE (message_text), {masked('message_text')} AS message_text,
          {label_columns(masked('message_text'))}
    FROM sub_rows WHERE feedback_id IN (SELECT id FROM subs WHERE result IS NULL))))""")
def completion_receipt(spark, sf):
    """Receipts are JSON documents; their fields are read back here."""
    ids = Z.submissions(spark, sf).where("result is null")
    done = U.receipts(_submission_rows(spark, sf), ids, "7", 3, 1)
    doc = F.from_json("result", "category STRING, issue_type STRING, sentiment STRING, rating INT, "
                                "processed INT, skipped INT, run_id STRING")
    return done.select("id", doc.alias("d"), "issue_key").select("id", "d.*", "issue_key")


@query("apply_receipts", """SELECT id, result IS NULL OR result LIKE '%"processed"%' AS by_this_run,
  'completed' AS status, strftime(CASE WHEN event_type = 'purchase' THEN created_at ELSE TIMESTAMP '2024-06-01' END,
    '%Y-%m-%d %H:%M:%S.%f') AS completed_at, CAST(NULL AS VARCHAR) AS dispatch_error FROM subs""")
def apply_receipts(spark, sf):
    """Receipts put back on the submissions, twice: a replay changes nothing."""
    subs = Z.submissions(spark, sf)
    done = U.receipts(_submission_rows(spark, sf), subs.where("result is null"), "7", 3, 1)
    at = F.lit("2024-06-01T00:00:00Z").cast("timestamp")
    once = U.apply_receipts(subs, done, at)
    twice = U.apply_receipts(once, done, at + F.make_dt_interval(days=F.lit(1)))
    status = U.submission_status(twice, Z.runs(spark, sf)).select("id", "status")
    return twice.join(status, "id").select("id", F.col("result").contains('"processed"').alias("by_this_run"), "status",
                                           "completed_at", "dispatch_error")


@query("decision_upsert", f"""SELECT issue_key, status, priority, owner, note,
  {stamp('decided_at')} FROM (SELECT * FROM new_decisions UNION ALL SELECT * FROM decisions
  WHERE issue_key NOT IN (SELECT issue_key FROM new_decisions))""")
def decision_upsert(spark, sf):
    from echoloom.operators import gates as G
    accepted, _ = G.split_accepted(G.validate_decisions(Z.decision_forms(spark, sf)))
    return D.apply_decisions(Z.decisions(spark, sf), accepted, issues.issue_groups(Z.grouped(spark, sf)))


# --- projections -----------------------------------------------------------------------

@query("normalize_app_store", f"SELECT {ROW} FROM ({norm_app('raw_app')})")
def normalize_app_store(spark, sf):
    return slim(X.normalize_app_store(Z.app_store_raw(spark, sf)))


@query("normalize_google_play", f"SELECT {ROW} FROM ({norm_play('raw_play')})")
def normalize_google_play(spark, sf):
    return slim(X.normalize_google_play(Z.google_play_raw(spark, sf)))


@query("normalize_in_app", f"SELECT {ROW} FROM ({norm_in('raw_in')})")
def normalize_in_app(spark, sf):
    return slim(X.normalize_in_app(Z.in_app_raw(spark, sf)))


@query("normalize_support", f"SELECT {ROW} FROM ({norm_sup('raw_sup')})")
def normalize_support(spark, sf):
    return slim(X.normalize_support(Z.support_raw(spark, sf)))


@query("canonical_cast", """SELECT 'orders' AS source, CAST(o_orderkey AS VARCHAR) AS feedback_id,
  CAST(o_custkey AS VARCHAR) AS user_id, CAST(CAST(o_totalprice AS INT) AS VARCHAR) AS message_text,
  CAST(CAST(substr(o_orderpriority, 1, 1) AS INT) AS VARCHAR) AS rating,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS "timestamp", CAST(NULL AS VARCHAR) AS app_version,
  o_orderstatus AS metadata FROM (SELECT * REPLACE (floor(o_totalprice) AS o_totalprice) FROM orders)""")
def canonical_cast(spark, sf):
    """Columns of any type, in any order, to the canonical row."""
    return X.canonical(Z.table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("metadata"), F.col("o_orderkey").alias("feedback_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.substring("o_orderpriority", 1, 1).alias("rating"), F.col("o_custkey").alias("user_id"),
        F.floor("o_totalprice").alias("message_text"), F.lit("orders").alias("source"),
        F.lit(None).alias("app_version")))


FP = ["source", "feedback_id", "user_id", "message_text", "rating", "app_version", "metadata"]


@query("row_fingerprint", f"SELECT source, feedback_id, {fingerprint(FP)} AS fingerprint FROM clean")
def row_fingerprint(spark, sf):
    return Z.clean(spark, sf).select("source", "feedback_id", identity.fingerprint(FP).alias("fingerprint"))


@query("mask_contacts", f"""SELECT source, feedback_id, {masked('user_id')} AS user_id,
  {masked('message_text')} AS message_text, {masked('metadata')} AS metadata FROM (
  SELECT * FROM corpus UNION ALL SELECT 'page', CAST(page_id AS VARCHAR), url, html, NULL, NULL, NULL, NULL
  FROM pages)""")
def mask_contacts(spark, sf):
    pages = Z.table(spark, sf, "pages").select(
        F.lit("page").alias("source"), F.col("page_id").cast("string").alias("feedback_id"),
        F.col("url").alias("user_id"), F.col("html").alias("message_text"),
        F.lit(None).cast("string").alias("metadata"))
    cols = pages.columns
    return mask(Z.corpus(spark, sf).select(*cols).unionByName(pages))


@query("ai_cache_key", f"SELECT source, feedback_id, {CACHE_KEY} AS _cache_key FROM clean")
def ai_cache_key(spark, sf):
    return Z.clean(spark, sf).select("source", "feedback_id", identity.cache_key().alias("_cache_key"))


def _keyed(spark, sf):
    return Z.stored(spark, sf).withColumn("_cache_key", identity.cache_key())


ANSWER = f"""SELECT {CACHE_KEY} AS _cache_key, {label_columns()} FROM clean"""


@query("classify_feedback", f"""SELECT _cache_key, category AS value, confidence_score,
  explanation AS rationale, sentiment FROM ({ANSWER})""")
def classify_feedback(spark, sf):
    return ai.keyword_scores(_keyed(spark, sf)).drop("error_message")


@query("udf_model_scoring", f"""SELECT _cache_key, category AS value, confidence_score,
  explanation AS rationale, sentiment FROM ({ANSWER})""")
def udf_model_scoring(spark, sf):
    """The same labels through the batch-model interface."""
    return ai.score(_keyed(spark, sf), ai.keyword_model()).drop("error_message")


@query("analyze_sentiment", f"""SELECT source, feedback_id, sentiment FROM (
  SELECT *, {label_columns()} FROM clean)""")
def analyze_sentiment(spark, sf):
    return ai.sentiment(Z.clean(spark, sf)).select("source", "feedback_id", "sentiment")


@query("parse_ai_response", f"""SELECT _cache_key, category AS value, confidence_score AS score,
  explanation AS rationale, CAST(NULL AS VARCHAR) AS error_message FROM ({ANSWER})""")
def parse_ai_response(spark, sf):
    return ai.parse_response(ai.classify(_keyed(spark, sf))).select(
        "_cache_key", "value", "score", "rationale", "error_message")


@query("extract_ai_fields", f"""SELECT _cache_key, category, confidence_score, explanation, sentiment,
  false AS uncertain_classification FROM ({ANSWER})""")
def extract_ai_fields(spark, sf):
    return ai.extract_labels(ai.classify(_keyed(spark, sf)))


@query("needs_review_flag", f"""SELECT source, feedback_id, {FLAG} AS needs_review FROM (
  SELECT *, CASE WHEN source = 'in_app' THEN ' ' ELSE 'x' END AS explanation,
    CASE WHEN source <> 'support' THEN rating / 4.0 END AS confidence_score,
    CASE WHEN source = 'app_store' THEN rating = 5 END AS uncertain_classification FROM corpus)""")
def needs_review_flag(spark, sf):
    source, rating = F.col("source"), F.col("rating")
    rows = Z.corpus(spark, sf).withColumns({
        "explanation": F.when(source == "in_app", " ").otherwise("x"),
        "confidence_score": F.when(source != "support", rating / 4.0),
        "uncertain_classification": F.when(source == "app_store", rating == 5)})
    return rows.select("source", "feedback_id", labels.review_flag().alias("needs_review"))


ALL_CATEGORIES = " UNION ALL ".join(
    f"SELECT source, feedback_id, {q(c)} AS category, message_text FROM clean" for c in S.ACTIONABLE)


@query("issue_type_rules", f"""SELECT source, feedback_id, category, {issue_type_case()} AS issue_type
  FROM ({ALL_CATEGORIES})""")
def issue_type_rules(spark, sf):
    """Every rule family over every message."""
    each = F.explode(F.array(*[F.lit(c) for c in S.ACTIONABLE]))
    rows = labels.with_ascii(Z.stored(spark, sf)).withColumn("category", each)
    return rows.select("source", "feedback_id", "category", labels.issue_type().alias("issue_type"))


@query("issue_category", """SELECT source, feedback_id, category, issue_cat FROM grouped""")
def issue_category(spark, sf):
    return issues.assign(Z.analyzed(spark, sf)).select("source", "feedback_id", "category", "issue_cat")


@query("dashboard_dataset", f"""SELECT source, feedback_id, user_id, md5(message_text) AS text_md5,
  {stamp()}, category, issue_cat, issue_type, sentiment, confidence_score, explanation,
  uncertain_classification, CASE WHEN trim(user_id, ' ') <> ''
    THEN CAST(to_json({{'source': source, 'user_id': user_id}}) AS VARCHAR) END AS source_user_key,
  CAST({FLAG} AS INT) AS needs_review,
  CASE WHEN {FLAG} THEN 'Needs review' ELSE 'Not flagged' END AS review_status FROM grouped""")
def dashboard_dataset(spark, sf):
    rows = explore.dashboard_rows(Z.grouped(spark, sf))
    return rows.withColumn("text_md5", F.md5("message_text")).drop("message_text")


@query("issue_key", f"""SELECT source, feedback_id, CASE WHEN issue_type IS NOT NULL
  THEN {issue_key()} END AS issue_key FROM grouped""")
def issue_key_query(spark, sf):
    return Z.grouped(spark, sf).select("source", "feedback_id", identity.row_issue_key().alias("issue_key"))


@query("reporter_key", """SELECT source, feedback_id, CASE WHEN trim(user_id) <> ''
  THEN CAST(to_json([source, user_id]) AS VARCHAR) END AS reporter FROM clean""")
def reporter_key(spark, sf):
    return Z.clean(spark, sf).select("source", "feedback_id", identity.reporter_key().alias("reporter"))


SOURCE_CASE = "CASE source " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in S.SOURCE_LABELS.items()) + " END"


def nice(col):
    words = f"replace(lower({col}), '_', ' ')"
    return f"upper(substr({words}, 1, 1)) || substr({words}, 2)"


@query("display_labels", f"""SELECT source, feedback_id, {SOURCE_CASE} AS source_label,
  {nice('category')} AS category_label, {nice('sentiment')} AS sentiment_label FROM analyzed""")
def display_labels(spark, sf):
    return explore.display(Z.analyzed(spark, sf))


@query("submission_status", """SELECT id, status,
  CASE WHEN status = 'failed' THEN 'The run ended early. The submission is kept; a retry is possible.'
    ELSE dispatch_error END AS error, status IN ('failed', 'saved') AS can_retry FROM (
  SELECT *, CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed'
    WHEN 'view' THEN 'failed' WHEN 'click' THEN 'processing' ELSE 'saved' END AS status FROM subs)""")
def submission_status(spark, sf):
    return U.submission_status(Z.submissions(spark, sf), Z.runs(spark, sf))


@query("scalar_functions", """SELECT doc_id, concat(lang, ':', source) AS concat_,
  concat_ws('|', lang, NULL, source) AS concat_ws_, substr(text, 1, 8) AS substring_,
  trim('  ' || source || ' ', ' ') AS trim_, length(text) AS length_, lower(source) AS lower_,
  upper(source) AS upper_, replace(source, 'src', 'S') AS replace_,
  regexp_replace(text, '[aeiou]', '', 'g') = text AS regexp_replace_,
  regexp_matches(text, '(?i)the') AS rlike_, contains(text, 'the') AS contains_, md5(text) AS md5_,
  sha256(text) AS sha2_, CAST(try_cast(source AS INT) AS VARCHAR) AS try_cast_,
  strftime(try_strptime('05/09/2026 07:03', '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M') AS try_to_timestamp_,
  strftime(epoch_ms(n_chars * 1000), '%Y-%m-%d %H:%M:%S') AS timestamp_millis_,
  CAST(CAST(date_trunc('week', epoch_ms(n_chars * 86400000)) AS DATE) AS VARCHAR) AS week_,
  n_chars BETWEEN 100 AND 1000 AS between_, coalesce(NULL, lang) AS coalesce_,
  (nullif(lang, 'en') IS NOT DISTINCT FROM NULL) AS null_safe_, lang IN ('de', 'fr') AS isin_,
  round(CASE WHEN n_chars > 0 THEN doc_id / n_chars END, 6) AS guarded_division_,
  CAST(to_json({'a': doc_id, 'b': NULL}) AS VARCHAR) AS to_json_, lang AS from_json_, lang AS variant_,
  lang AS get_ FROM documents""")
def scalar_functions(spark, sf):
    """Each scalar function of the inventory over whole documents."""
    text, lang, source, n, doc = (F.col(c) for c in ["text", "lang", "source", "n_chars", "doc_id"])
    js = F.to_json(F.struct(F.array(F.struct(lang.alias("v"))).alias("r")))
    return Z.table(spark, sf, "documents").select(
        doc, F.concat(lang, F.lit(":"), source).alias("concat_"),
        F.concat_ws("|", lang, F.lit(None).cast("string"), source).alias("concat_ws_"),
        F.substring(text, 1, 8).alias("substring_"),
        F.trim(F.concat(F.lit("  "), source, F.lit(" "))).alias("trim_"),
        F.length(text).cast("bigint").alias("length_"), F.lower(source).alias("lower_"),
        F.upper(source).alias("upper_"),
        F.replace(source, F.lit("src"), F.lit("S")).alias("replace_"),
        (F.regexp_replace(text, "[aeiou]", "") == text).alias("regexp_replace_"),
        text.rlike("(?i)the").alias("rlike_"), text.contains("the").alias("contains_"),
        F.md5(text).alias("md5_"), F.sha2(text, 256).alias("sha2_"),
        source.try_cast("int").cast("string").alias("try_cast_"),
        F.date_format(F.try_to_timestamp(F.lit("05/09/2026 07:03"), F.lit("dd/MM/yyyy HH:mm")),
                      "yyyy-MM-dd HH:mm").alias("try_to_timestamp_"),
        F.date_format(F.timestamp_millis(n * 1000), "yyyy-MM-dd HH:mm:ss").alias("timestamp_millis_"),
        F.to_date(F.date_trunc("week", F.timestamp_millis(n * 86400000))).alias("week_"),
        n.between(100, 1000).alias("between_"), F.coalesce(F.lit(None), lang).alias("coalesce_"),
        F.nullif(lang, F.lit("en")).eqNullSafe(F.lit(None)).alias("null_safe_"),
        lang.isin("de", "fr").alias("isin_"), F.when(n > 0, doc / n).alias("guarded_division_"),
        F.to_json(F.struct(doc.alias("a"), F.lit(None).cast("string").alias("b")),
                  {"ignoreNullFields": "false"}).alias("to_json_"),
        F.from_json(js, "r ARRAY<STRUCT<v:STRING>>")["r"][0]["v"].alias("from_json_"),
        F.try_variant_get(F.try_parse_json(js), "$.r[0].v", "string").alias("variant_"),
        F.get(F.array(lang), F.lit(0)).alias("get_"))
