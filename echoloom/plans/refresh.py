"""The refresh: prepare -> analyze -> group -> publish.

Each step reads stages, writes stages and evaluates its gates and counts in one aggregation
over what it wrote. A step can be repeated; publication happens last.

A run reads and writes only the buckets that hold keys of its load. The other buckets stay as
they are published, and enter the metrics by their stored counts.
"""

import json

from pyspark.sql import DataFrame, functions as F, types as T

from echoloom import schemas as S
from echoloom.functions import labels
from echoloom.functions.rules import CLASSIFIER_VERSION
from echoloom.functions.text import mask
from echoloom.operators import ai, gates as G, incremental as I, issues
from echoloom.plans.audit import with_audit
from echoloom.tables import COUNTED, KEYED, Store, counts_of, key_bucket, user_bucket

STAGES = {"prepared": ("feedback_clean", "_status STRING"), "analyzed": ("feedback_analyzed", "_reused BOOLEAN"),
          "grouped": ("feedback_with_issue_type", "_same BOOLEAN, _known BOOLEAN"), "evidence": ("issue_evidence", None),
          "parts": ("issue_parts", None), "newest": ("issue_newest", None),
          "users": ("issue_users", None), "reporters": ("issue_reporters", None)}
# Stages in parts by cache key: answers meet their texts without a shuffle.
ANSWERS = {"pending": T.StructType([*[S.CLEAN[c] for c in (*S.KEYS, "message_text")], T.StructField("_cache_key", T.StringType())]),
           **dict.fromkeys(("known_answers", "ai_responses", "new_answers"), S.AI_CACHE)}
IDENTITY = "duplicate or empty feedback keys"
CONTACTS = "records still hold contact details; publication stopped"


class Refresh:
    """One run over a Store. `make_model` builds a batch model per task; None = keyword rules."""

    def __init__(self, store: Store, run_id: str, make_model=None, version=CLASSIFIER_VERSION,
                 audit=False):
        self.store, self.run_id, self.make_model = store, str(run_id), make_model
        self.version, self.audit, self.metrics = version, audit, {}
        self._baseline = self._users = self._entry = None   # small rows, read once

    def save(self, df, name, keys=()) -> DataFrame:
        return self.store.save_stage(df, self.run_id, name, ["_cache_key"] if name in ANSWERS else keys)

    def save_buckets(self, df, name) -> DataFrame:
        """Save the touched buckets of a table as a stage."""
        by_user = STAGES[name][0] in S.BY_USER
        cut = F.col("bucket") if "bucket" in df.columns else (user_bucket if by_user else key_bucket)(self.store.buckets)
        keys = S.KEYS if STAGES[name][0] in KEYED else ()
        self.store.save_buckets(df, self.store.stage_path(self.run_id, name), cut, keys)
        return self.stage(name)

    def stage(self, name) -> DataFrame:
        """A stage; a stage in buckets has the bucket as its last column."""
        if name in ANSWERS:
            return self.store.stage(self.run_id, name, ANSWERS[name], ["_cache_key"])
        if name not in STAGES:
            return self.store.stage(self.run_id, name)
        table, more = STAGES[name]
        extra = T.StructType.fromDDL(more).fields if more else []
        schema = T.StructType([*S.PUBLISHED[table].fields, *extra, T.StructField("bucket", T.IntegerType())])
        return self.store.stage(self.run_id, name, schema, S.KEYS if table in KEYED else ())

    def run(self, incoming: DataFrame) -> dict:
        """All four steps; returns the metrics per step."""
        self.step("prepare", incoming)
        for name in ("analyze", "group", "publish"):
            self.step(name)
        return self.metrics

    def step(self, name, *args) -> dict:
        """One step with its report. A failing report never hides the step's own error."""
        metrics = self.metrics[name] = {"processed": 0, "skipped": 0, "failed": 0}
        if name != "publish" and self.store.has_published(self.run_id):
            # The stages of a published run are the published tables: a replay keeps them.
            if args and self._digest(self._loaded(*args)) != self._bound():
                raise ValueError(f"run {self.run_id} is published with another input; use a new run ID")
            metrics.update(self._saved_metrics(name))
            return metrics
        try:
            getattr(self, name)(metrics, *args)
        except Exception as error:
            metrics["failed"] = max(1, metrics["failed"])
            metrics["error_type"] = type(error).__name__
            try:
                self._report(name, "FAILED", metrics)
            except Exception as report_error:
                metrics["report_error"] = type(report_error).__name__
            raise
        self._report(name, "SUCCEEDED", metrics)
        return metrics

    def _report(self, name, status, metrics):
        self.store.record_report(self.run_id, name, status, json.dumps(metrics))

    def _saved_metrics(self, name) -> dict:
        row = self.store.reports().where((F.col("run_id") == self.run_id) & (F.col("step") == name)
                                         & (F.col("status") == "SUCCEEDED")) \
            .orderBy(F.desc("recorded_at")).first()
        return json.loads(row["report"]) if row else {}

    @staticmethod
    def _loaded(incoming: DataFrame) -> DataFrame:
        """The load as it is staged: one masked row per payload, with its copies."""
        flagged = I.dedupe(incoming).withColumns({"_malformed": G.malformed_rating(), "_bad": G.bad_record()})
        return mask(flagged)

    @staticmethod
    def _digest(loaded: DataFrame, *more) -> tuple:
        """Rows and a hash of a load, whatever its order."""
        hashed = F.xxhash64(*S.BASE, "_copies").cast("decimal(38,0)")
        r = loaded.agg(F.sum("_copies").alias("n"), F.sum(hashed).alias("h"), *more).first()
        return r["n"] or 0, str(r["h"]), *r[2:]

    def _bound(self) -> tuple:
        """Digest of the input that this run ID stands for."""
        r = self.stage("input").first()
        return r["rows"], r["digest"]

    def pin(self, version, touched=None):
        """Bind the run to a version, and to the buckets that it renews (all of them by default)."""
        touched = list(range(self.store.buckets)) if touched is None else touched
        self.save(self.store.spark.createDataFrame([(version, touched)], "version BIGINT, touched ARRAY<INT>"), "baseline")
        self._baseline, self._entry = (version, touched), None

    def pinned(self) -> int:
        self._baseline = self._baseline or tuple(self.stage("baseline").select("version", "touched").first())
        return self._baseline[0]

    def touched(self) -> list[int]:
        self.pinned()
        return self._baseline[1]

    def before(self) -> dict:
        """The log entry of the version that the run is pinned to."""
        self._entry = self._entry or self.store.entry(self.pinned())
        return self._entry

    def user_buckets(self) -> list[int]:
        if self._users is None:
            self._users = self.stage("user_buckets").first()["touched"]
        return self._users

    def untouched(self, touched) -> list[int]:
        return [b for b in range(self.store.buckets) if b not in set(touched)]

    def baseline(self, name) -> DataFrame:
        """The touched buckets of a table as the run found it."""
        return self.store.read(name, self.before(), self.touched())

    def rest(self, name, field) -> int:
        """A count over the buckets of a table that the run leaves alone."""
        alone = self.untouched(self.touched())
        counts = counts_of(self.before()).get(name)
        return sum(counts[b][field] for b in alone) if alone else 0

    # --- steps ------------------------------------------------------------------------

    def prepare(self, metrics, incoming: DataFrame):
        """Dedupe, mask and lay the load over the saved rows.

        The raw input is read once. Gates on the original payload are carried as flags and
        copy counts through the dedup; masked rows are all that is written.
        """
        head = self.store.head()
        if head is None:
            raise ValueError("nothing is published yet: call Store.bootstrap before the first run")
        # laid out by key once: from here on, joins by key find their rows where they lie
        loaded = self.save(self.store.few_tasks(self._loaded(incoming)), "incoming", S.KEYS)
        # at most one value for each bucket
        rows, digest, buckets = self._digest(loaded, F.collect_set(key_bucket(self.store.buckets)))
        self.pin(head["version"], sorted(buckets) if self.store.in_buckets(head) else None)
        self.save(self.store.spark.createDataFrame([(rows, digest)], "rows BIGINT, digest STRING"), "input")
        load = G.row(G.key_violations(
            loaded, weight="_copies", malformed=F.col("_malformed"), bad=F.col("_bad"),
            empty=G.empty_key()))
        metrics["input_rows"] = load["checked_rows"]
        G.enforce(load, {"malformed": "ratings of store reviews are not whole numbers from 1 to 5",
                         "bad": "rows lack a text or a time, or their rating is out of range",
                         "duplicate_keys": "one key came with different contents in this load",
                         "empty": IDENTITY}, metrics)
        metrics["deduplicated"] = load["checked_rows"] - load["keys"]

        # The contact gate runs on the result, which holds every masked row of the load.
        result = self.save_buckets(I.align(loaded, self.baseline("feedback_clean")), "prepared")
        status = F.col("_status")
        total = G.row(G.key_violations(
            result, empty=G.empty_key(), contacts=G.contact_left(),
            processed=status.isin("new", "changed"), skipped=status == "same",
            retained=status == "retained"))
        G.enforce(total, {"contacts": CONTACTS, "empty": IDENTITY, "duplicate_keys": IDENTITY},
                  metrics)
        alone = self.rest("feedback_clean", "rows")
        metrics.update(processed=total["processed"], skipped=total["skipped"],
                       retained_from_previous=total["retained"] + alone, total=total["checked_rows"] + alone)

    def analyze(self, metrics):
        """Label new and changed text once; everything else keeps its saved label.

        The cache is read once, and only in the buckets of the pending keys. An answer that another
        run caches meanwhile is not seen: this run uses its own.
        """
        prepared, prior = self.stage("prepared").drop("_status", "bucket"), self.baseline("feedback_analyzed")
        asked = I.pending(prepared, prior, self.version).select(ANSWERS["pending"].names)
        pending = self.save(self.store.by_parts(asked, ["_cache_key"]), "pending")
        known = self.save(self.store.cached(pending), "known_answers")
        fresh = I.uncached(pending, known)
        responses = with_audit(
            lambda: self.save(ai.classify(fresh, self.make_model), "ai_responses"),
            self._record_audit if self.audit else None, metrics)
        valid, failed = ai.split_responses(responses)
        checked = ai.parse_response(responses).agg(
            F.count("*").alias("ai_messages"),
            F.count(F.when(~ai.response_ok(), 1)).alias("responses")).first().asDict()
        metrics["ai_messages"] = checked["ai_messages"]
        if checked["responses"]:
            self.save(failed, "failed_ai_responses")
        added = self.save(I.insert_missing(known, valid, "_cache_key"), "new_answers")
        if checked["ai_messages"]:
            # before failing: good answers are not asked again
            self.store.append_cache(added, self.run_id)
        G.enforce(checked, {"responses": "AI responses failed validation; the others are cached"},
                  metrics)

        answers = known.unionByName(added)
        unique = G.row(G.unique_keys(answers, ["_cache_key"]))
        G.enforce(unique, {"duplicate_keys": "a key was answered from the cache and anew",
                           "empty_keys": "an answer has an empty key"}, metrics)
        # answers go to the rows: their keys are unique, which `prepare` has enforced
        attached = I.attach(pending.select("_cache_key", *S.KEYS), answers)
        labelled = prepared.join(self.store.by_parts(attached, S.KEYS), S.KEYS)
        new = ai.extract_labels(labelled).select(*S.ANALYZED.names, F.lit(False).alias("_reused"))
        reused = I.reuse_labels(prepared, prior).withColumn("_reused", F.lit(True))
        result = self.save_buckets(reused.unionByName(new)
                                   .withColumn("uncertain_classification", labels.review_flag()), "analyzed")
        got = G.row(G.key_violations(
            result, empty=G.empty_key(), labels=~F.col("_reused") & G.invalid_label(),
            new=~F.col("_reused"), reused=F.col("_reused"),
            needs_review=F.col("uncertain_classification")))
        got["missing"] = pending.count() - got["new"]
        got["lost"] = prepared.count() - got["checked_rows"]
        if got["labels"]:
            self.save(result.where(~F.col("_reused") & G.invalid_label()), "failed_analysis")
        G.enforce(got, {"labels": "new labels are not in the vocabulary; see stage failed_analysis",
                        "duplicate_keys": IDENTITY, "empty": IDENTITY,
                        "missing": "some requested answers did not arrive",
                        "lost": "feedback rows were lost in analysis"}, metrics)
        metrics.update(processed=got["new"], skipped=got["reused"] + self.rest("feedback_analyzed", "rows"),
                       needs_review=got["needs_review"] + self.rest("feedback_analyzed", "review"))

    def _record_audit(self, responses: DataFrame):
        """Masked inputs next to the saved answers, by feedback key."""
        asked = self.stage("pending").select("_cache_key", *S.KEYS, "message_text")
        self.save(asked.join(responses, "_cache_key")
                  .withColumn("classifier_version", F.lit(self.version)), "ai_audit")

    def group(self, metrics):
        """Issue membership: saved groups stay for unchanged text and category."""
        analyzed, old = self.stage("analyzed"), self.baseline("feedback_with_issue_type")
        rows = I.with_saved_group(analyzed, old)
        rows = labels.with_ascii(rows, ~F.col("_same") & labels.has_rules()) \
            .withColumn("issue_type", F.when(F.col("_same"), F.col("_saved.issue_type"))
                        .otherwise(labels.issue_type())) \
            .withColumn("issue_cat", F.when(F.col("_same"), F.col("_saved.issue_cat"))
                        .otherwise(labels.issue_cat())) \
            .select(*S.GROUPED.names, "_same", F.col("_saved").isNotNull().alias("_known"))
        grouped = self.save_buckets(rows, "grouped")
        got = G.row(G.key_violations(
            grouped, empty=G.empty_key(), membership=G.missing_membership(),
            contacts=G.contact_left(), same=F.col("_same"), known=F.col("_known"),
            active=F.col("issue_type").isNotNull(),
            needs_review=F.col("uncertain_classification")))
        got["lost"] = analyzed.count() - got["checked_rows"]
        G.enforce(got, {"membership": "an active message has no issue",
                        "duplicate_keys": IDENTITY, "empty": IDENTITY, "contacts": CONTACTS,
                        "lost": "feedback rows were lost in grouping"}, metrics)
        final, n_active = grouped.select(*S.GROUPED.names), got["active"]
        if old.count() > got["known"]:      # rows that only the published table holds stay in it
            final = I.upsert(old, final, S.KEYS, S.GROUPED.names)
            n_active = issues.active(final).count()
        summary = self.summarise(final, old)
        sums = summary.agg(F.count("*").alias("types"),
                           F.coalesce(F.sum("total_messages"), F.lit(0)).alias("n")).first()
        n_active += self.rest("feedback_with_issue_type", "active")
        G.enforce({"reconcile": abs(sums["n"] - n_active)},
                  {"reconcile": "messages differ between summary and membership"}, metrics)
        metrics.update(processed=got["checked_rows"] - got["same"],
                       skipped=got["same"] + self.rest("feedback_with_issue_type", "rows"),
                       needs_review=got["needs_review"] + self.rest("feedback_with_issue_type", "review"),
                       actionable_messages=n_active, issue_types=sums["types"])

    def summarise(self, final: DataFrame, old: DataFrame) -> DataFrame:
        """Renew the touched parts of the summary and add up all parts.

        All evidence is published in rows of bounded size; the summary shows the newest. Of
        the reporters only those are counted anew whose messages came or went.
        """
        before, touched, everything = self.before(), self.touched(), range(self.store.buckets)
        rows = final.withColumn("bucket", key_bucket(self.store.buckets))
        self.save_buckets(issues.issue_examples(rows, within=["bucket"], keep=lambda p: self.save(p, "large_days")),
                          "evidence")
        parts = self.save_buckets(issues.part_totals(rows, "bucket"), "parts")
        newest = self.save_buckets(issues.top_messages(rows, issues.NEWEST, [*issues.ISSUE, "bucket"])
                                   .select(*S.NEWEST.names, "bucket"), "newest")
        alone = self.untouched(touched)
        if alone:
            delta = self.save(issues.added_up(issues.user_messages(final), issues.user_messages(old, -1)), "user_changes")
            users = sorted(r["b"] for r in delta.select(user_bucket(self.store.buckets).alias("b")).distinct().collect())
        else:
            delta, users = issues.user_messages(final), list(everything)
        self.save(self.store.spark.createDataFrame([(users,)], "touched ARRAY<INT>"), "user_buckets")
        self._users = users
        if alone:
            delta = issues.added_up(self.store.read("issue_users", before, users), delta)
        counted = self.save_buckets(delta, "users")
        if alone:
            G.enforce({"users": counted.where("messages < 0").count()},
                      {"users": "more messages of a user were taken back than there were"})
        reporters = self.save_buckets(counted.groupBy(*issues.ISSUE, "bucket").agg(F.count("*").alias("reporters")), "reporters")

        def whole(name, renewed, buckets):
            kept = self.untouched(buckets)
            new = renewed.select(*S.PUBLISHED[name].names)
            return new.unionByName(self.store.read(name, before, kept)) if kept else new
        return self.save(issues.merged_summary(whole("issue_parts", parts, touched), whole("issue_reporters", reporters, users),
                                               whole("issue_newest", newest, touched)), "summary")

    def publish(self, metrics):
        """Switch to the new version of all tables with one log file.

        The touched buckets of the stages are published in place, and the others as they are.
        Rows that only a published table holds stay in it: its touched buckets are then merged.
        """
        pin, head = self.pinned(), self.store.head()
        grouped = self.stage("grouped").select(*S.GROUPED.names)
        published = self.store.has_published(self.run_id)
        if not published and head["version"] != pin:
            raise G.GateFailure("baseline", 1, "another run published meanwhile; "
                                               "repeat this load under a new run ID")
        old = self.baseline("feedback_with_issue_type")
        change = F.col("change")
        diff = I.record_diff(grouped, old, S.GROUPED.names, laid=True).agg(
            F.count("*").alias("all"), F.count(F.when(change == "removed", 1)).alias("kept")).first()
        metrics["processed"] = diff["all"]
        if not published:
            analyzed, prior = self.stage("analyzed"), self.baseline("feedback_analyzed")
            lacking = {"feedback_analyzed": G.missing_rows(prior, analyzed).count(), "feedback_with_issue_type": diff["kept"]}
            touched, users, before = self.touched(), self.user_buckets(), self.before()
            folders = {"issue_summary": self.store.stage_path(self.run_id, "summary")}
            for stage, (name, _) in STAGES.items():
                path = self.store.stage_path(self.run_id, stage)
                if lacking.get(name):
                    path = self.store._path(name, self.run_id)
                    merged = I.upsert(self.baseline(name), self.stage(stage), S.KEYS, S.PUBLISHED[name].names)
                    self.store.save_buckets(merged, path, key_bucket(self.store.buckets), S.KEYS if name in KEYED else ())
                renewed = self.store.bucket_folders(path)
                mine = set(users if name in S.BY_USER else touched)
                folders[name] = [renewed.get(b, "") if b in mine else before["folders"][name][b]
                                 for b in range(self.store.buckets)]
            stats = {name: self._counts(name, folders[name], before, touched) for name in COUNTED}
            name = "feedback_with_issue_type"
            final = self.store.read_folders(name, [folders[name][b] for b in touched], laid=True)
            G.enforce(G.row(G.unique_keys(final)), {"duplicate_keys": IDENTITY,
                                                    "empty_keys": IDENTITY}, metrics)
            self.store.commit(self.run_id, pin, folders, stats, self.store.cut)
        got = grouped.agg(F.count("*").alias("n"),
                          F.count(F.when(F.col("uncertain_classification"), 1)).alias("r")).first()
        alone = {f: self.rest("feedback_with_issue_type", f) for f in ("rows", "review")}
        metrics.update(skipped=got["n"] + alone["rows"] - metrics["processed"], total=got["n"] + alone["rows"],
                       needs_review=got["r"] + alone["review"])

    def _counts(self, name, folders, before, touched) -> list[dict]:
        """Counts per bucket: renewed ones are counted, the others are as before."""
        rows = self.store.read_folders(name, [folders[b] for b in touched], laid=True)
        flag = lambda c, of: F.count(F.when(of, 1)).alias(c) if of is not None else F.lit(0).cast("long").alias(c)
        found = rows.groupBy(key_bucket(self.store.buckets).alias("b")).agg(
            F.count("*").alias("rows"), flag("review", F.col("uncertain_classification") if "uncertain_classification" in rows.columns else None),
            flag("active", F.col("issue_type").isNotNull() if "issue_type" in rows.columns else None))
        new = {r["b"]: {f: r[f] for f in ("rows", "review", "active")} for r in found.collect()}
        kept = counts_of(before).get(name) or [None] * self.store.buckets
        return [new.get(b, {"rows": 0, "review": 0, "active": 0}) if b in set(touched) else kept[b]
                for b in range(self.store.buckets)]
