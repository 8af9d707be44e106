"""Publication of changed buckets only, and the summary from stored parts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from echoloom import schemas as S
from echoloom.operators import issues
from echoloom.plans.refresh import Refresh
from echoloom.session import scratch
from echoloom.tables import CLEAN_UP, Store

TEXTS = ["Payment failed", "Delivery was late", "Please add dark mode", "Great service", "The order is wrong"]


def load(n, start=0, shift=0):
    return [(("support", "in_app")[i % 2], str(i), f"u{i % 7}", f"{TEXTS[(i + shift) % 5]} {i}", None, f"2026-01-{i % 28 + 1:02d}")
            for i in range(start, start + n)]


def summary(df):
    return {(r.issue_category, r.issue_type): (r.total_messages, r.unique_users, round(r.avg_confidence, 9), r.uncertain_messages,
                                               r.first_reported, r.last_reported, [e.message for e in r.example_messages])
            for r in df.collect()}


def changed(store, a, b):
    """Per table, how many folders differ between two versions."""
    old, new = store.entry(a)["folders"], store.entry(b)["folders"]
    return {name: sum(x != y for x, y in zip(old[name], new[name])) for name in S.PUBLISHED}


def check(store):
    """All that is published equals what the whole table gives."""
    rows = store.read("feedback_with_issue_type")
    assert summary(store.read("issue_summary")) == summary(issues.issue_summary(rows, issues.NEWEST))
    shown = store.read("issue_evidence").select(F.explode("example_messages.message").alias("m"))
    assert sorted(r.m for r in shown.collect()) == sorted(r.message_text for r in issues.active(rows).collect())
    users = {(r.issue_cat, r.issue_type, r.source, r.user_id): r.messages for r in store.read("issue_users").collect()}
    assert users == {(r.issue_cat, r.issue_type, r.source, r.user_id): r.messages for r in issues.user_messages(rows).collect()}
    entry = store.head()
    for name, counts in entry["stats"].items():
        assert sum(c["rows"] for c in counts) == store.read(name).count()


@pytest.fixture
def wide(spark):
    """Eight buckets; the load before fills them all."""
    return Store(spark, scratch(spark, "wide"), buckets=8).bootstrap()


def test_a_run_writes_the_buckets_it_touches(wide, feedback):
    Refresh(wide, "1").run(feedback(*load(60)))
    check(wide)
    # one row with another text: one bucket of every table by key, the issues of one user
    row = load(60)[3]
    metrics = Refresh(wide, "2").run(feedback((*row[:3], "Delivery was late again", *row[4:])))
    got = changed(wide, 1, 2)
    assert all(got[name] == 1 for name in S.BY_KEY) and all(got[name] == 1 for name in S.BY_USER)
    assert metrics["prepare"]["total"] == 60 and metrics["prepare"]["retained_from_previous"] == 59
    assert metrics["publish"] == metrics["publish"] | {"processed": 1, "total": 60, "skipped": 59}
    check(wide)
    # an old version is still whole
    assert wide.read("feedback_with_issue_type", 1).count() == 60
    assert wide.read("feedback_clean", 1).where("message_text like '%again'").count() == 0


def test_unchanged_and_empty_loads(wide, feedback):
    Refresh(wide, "1").run(feedback(*load(40)))
    again = Refresh(wide, "2").run(feedback(load(40)[5]))
    assert again["publish"]["processed"] == 0 and changed(wide, 1, 2)["issue_users"] == 0
    check(wide)
    Refresh(wide, "3").run(feedback(*load(0)))
    assert not any(n for name, n in changed(wide, 2, 3).items() if name != "issue_summary")
    check(wide)


def test_messages_that_leave_an_issue(wide, feedback):
    """Texts change to another issue or to none: totals and reporters go down exactly."""
    Refresh(wide, "1").run(feedback(*load(50)))
    Refresh(wide, "2").run(feedback(*load(6, 0, 3)))
    check(wide)
    Refresh(wide, "3").run(feedback(*load(5, 100)))
    check(wide)


def test_other_number_of_buckets(spark, wide, feedback):
    """A store opened with another number cuts its tables anew."""
    Refresh(wide, "1").run(feedback(*load(30)))
    other = Store(spark, wide.root, buckets=3)
    Refresh(other, "2").run(feedback(load(30)[0]))
    assert all(len(other.head()["folders"][name]) == 3 for name in S.BY_KEY)
    assert other.read("feedback_clean").count() == 30
    check(other)


def test_buckets_are_written_as_rows_come(spark, wide, feedback):
    """No shuffle of its own: two tasks that hold every bucket write two files for each."""
    rows = feedback(*load(400)).repartition(2)
    wide.save_buckets(rows, f"{wide.root}/cut", F.col("rating").isNull().cast("int") + F.length("user_id") % 2)
    files = spark.read.parquet(f"{wide.root}/cut").groupBy("bucket", F.input_file_name().alias("f")).count()
    assert {r.bucket: r.n for r in files.groupBy("bucket").agg(F.count("*").alias("n")).collect()} == {1: 2}
    assert spark.read.parquet(f"{wide.root}/cut").count() == 400


def test_stages_leave_no_shuffle_files(spark, wide, feedback):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in kept.getAllFiles().mkString(" ").split() if "/shuffle_" in f}
    before, setting = files(), spark.conf.get(CLEAN_UP)
    wide.save_stage(feedback(*load(50)).groupBy("user_id").count(), "1", "n")
    assert not files() - before and spark.conf.get(CLEAN_UP) == setting


def test_keyed_stages_meet_without_a_shuffle(spark, wide, feedback):
    """Rows are dealt by key once a run: joins and gates of the later steps find them where they lie."""
    from echoloom.operators import gates as G, incremental as I
    run = Refresh(wide, "1")
    run.run(feedback(*load(60)))
    again = Refresh(wide, "2")
    again.step("prepare", feedback(*load(20, 0, 1)))
    prepared, prior = again.stage("prepared").drop("_status", "bucket"), again.baseline("feedback_analyzed")
    old = again.baseline("feedback_with_issue_type")
    for df in [I.pending(prepared, prior), I.reuse_labels(prepared, prior), I.with_saved_group(run.stage("analyzed"), old),
               I.record_diff(run.stage("grouped").select(*S.GROUPED.names), old, S.GROUPED.names), G.duplicate_keys(prepared),
               I.attach(run.stage("pending"), run.stage("new_answers"))]:
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    again.step("analyze")
    again.step("group")
    again.step("publish")
    check(wide)


def test_versions_laid_out_before_are_cut_anew(wide, feedback):
    """A version of this many folders whose log names no layout: every bucket is read and written again."""
    Refresh(wide, "1").run(feedback(*load(30)))
    head = wide.head()
    wide.commit("older", 1, head["folders"], {n: [c.asDict() for c in cs] for n, cs in head["stats"].items()})
    Refresh(wide, "2").run(feedback(load(31)[30]))
    assert all(a != b for a, b in zip(wide.entry(2)["folders"]["feedback_clean"], wide.head()["folders"]["feedback_clean"]) if a and b)
    assert wide.read("feedback_clean").count() == 31
    check(wide)


def test_a_load_is_shuffled_once(spark, wide, feedback):
    """The load is laid into parts as it comes out of its dedup: a part then has a file per task, and is read as one."""
    rows = feedback(*load(200)).repartition(3)
    plain = Refresh._loaded(rows)
    written = wide.few_tasks(plain)._jdf.queryExecution().executedPlan().toString()
    assert written.count("Exchange hashpartitioning") == plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    run = Refresh(wide, "1")
    run.step("prepare", rows)
    assert run.stage("incoming").count() == 200
    by_key = wide.stage("1", "incoming", S.CLEAN, S.KEYS).groupBy(*S.KEYS).count()
    assert "Exchange hashpartitioning" not in by_key._jdf.queryExecution().executedPlan().toString()
    assert by_key.where("count = 1").count() == 200


def test_a_write_begins_with_many_pieces(spark, wide):
    """A session's few shuffle partitions do not make the pieces of a large load: Spark only joins small ones."""
    from echoloom.tables import LEAST_PIECES, PIECES, shuffles_dropped
    assert spark.conf.get(PIECES, None) is None
    with shuffles_dropped(spark):
        assert int(spark.conf.get(PIECES)) == LEAST_PIECES
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    assert spark.conf.get(PIECES, None) is None


def test_laid_rows_are_compared_as_their_hashes(spark):
    """`record_diff` over rows that lie in parts compares the rows, and finds what their hashes find."""
    from echoloom.operators import incremental as I
    schema = "source string, feedback_id string, score double, timestamp timestamp, message_text string"
    at = lambda s: dt.datetime.fromisoformat(f"2026-01-01T00:00:{s}")
    old = [("a", "1", 0.0, at("00.001400"), "x"), ("a", "2", float("nan"), None, None), ("a", "3", 0.5, at("01"), "y"), ("a", "4", 0.1, at("02"), "z"),
           ("a", "6", None, at("00.001"), "null")]
    new = [("a", "1", -0.0, at("00.001900"), "x"), ("a", "2", float("nan"), None, None), ("a", "3", 0.5, at("01.002"), "y"), ("a", "5", 0.1, at("02"), "z"),
           ("a", "6", None, at("00.001"), None)]
    left, right = (spark.createDataFrame(r, schema) for r in (new, old))
    found = [{tuple(r) for r in I.record_diff(left, right, left.columns, laid).collect()} for laid in (False, True)]
    assert found[0] == found[1] == {("a", "1", "changed"), ("a", "3", "changed"), ("a", "4", "removed"), ("a", "5", "added"), ("a", "6", "changed")}
    text = I.record_diff(left, right, left.columns, True)._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in text and "to_json" not in text.lower()
