import os

import pytest
from pyspark.sql import functions as F

from echoloom.functions.identity import cache_key
from echoloom.operators.ai import keyword_model
from echoloom.operators.gates import GateFailure
from echoloom.plans.audit import with_audit
from echoloom.plans.refresh import Refresh
from echoloom.plans.submissions import submission_refresh
from echoloom.sources.exports import read_snapshot
from echoloom.tables import Conflict, Store, cache_bucket

ROWS = [("support", "1", "u1", "Payment failed, call 07700 900190", None, "2026-01-01"),
        ("support", "2", "u2", "Delivery was late", None, "2026-01-02"),
        ("app_store", "1", "u1", "Please add dark mode", 5, "2026-01-03"),
        ("app_store", "2", "u3", "Great service", 4, "2026-01-04")]


def flaky():
    """A model that fails on one message."""
    make = keyword_model()

    class Flaky:
        def predict(self, batch):
            out = make().predict(batch)
            out.loc[batch["message_text"].str.contains("late").to_numpy(), "error_message"] = "busy"
            return out

    return Flaky


def table(store, name="feedback_with_issue_type"):
    return {(r.source, r.feedback_id): r for r in store.read(name).collect()}


def test_first_and_second_run(store, feedback):
    first = Refresh(store, "1").run(feedback(*ROWS, ROWS[0]))
    assert first["prepare"] == {"processed": 4, "skipped": 0, "failed": 0, "input_rows": 5, "deduplicated": 1,
                                "retained_from_previous": 0, "total": 4}
    assert first["analyze"]["ai_messages"] == 4 and first["publish"]["processed"] == 4
    rows = table(store)
    assert rows["support", "1"].message_text == "Payment failed, call [PHONE]"
    assert rows["support", "1"].issue_type == "Payment/Checkout Failure" and rows["support", "1"].issue_cat == "BUG"
    assert rows["app_store", "2"].issue_type is None
    assert store.read("issue_summary").agg(F.sum("total_messages")).first()[0] == 3

    again = Refresh(store, "2").run(feedback(*ROWS))
    assert again["analyze"]["ai_messages"] == 0 and again["prepare"]["processed"] == 0
    assert again["analyze"]["skipped"] == 4 and again["publish"]["processed"] == 0
    assert table(store) == rows

    # A changed text is labelled again and stays one row; rows that are gone are kept.
    changed = ROWS[1][:3] + ("The order is wrong",) + ROWS[1][4:]
    third = Refresh(store, "3").run(feedback(changed))
    assert third["analyze"]["ai_messages"] == 1 and third["prepare"]["retained_from_previous"] == 3
    assert table(store)["support", "2"].issue_type == "Wrong Order" and len(table(store)) == 4
    assert len(store.read("feedback_clean", 1).collect()) == 4       # a pinned version
    assert store.read("feedback_with_issue_type", 1).where("message_text = 'Delivery was late'").count() == 1


def test_rating_change_keeps_labels(store, feedback):
    Refresh(store, "1").run(feedback(*ROWS))
    better = ROWS[3][:4] + (5, ROWS[3][5])
    run = Refresh(store, "2").run(feedback(better))
    assert run["prepare"]["processed"] == 1 and run["analyze"]["ai_messages"] == 0
    assert table(store)["app_store", "2"].rating == 5


@pytest.mark.parametrize("rows, gate", [
    ([("app_store", "1", "u", "x", None, "2026-01-01")], "malformed"),
    ([("support", "1", "u", " ", None, "2026-01-01")], "bad"),
    ([("support", "1", "u", "x", 6, "2026-01-01")], "bad"),
    ([("support", "1", "u", "x", 1, "2026-01-01"), ("support", "1", "u", "y", 1, "2026-01-01")], "duplicate_keys"),
    ([("support", " ", "u", "x", 1, "2026-01-01")], "empty")])
def test_gates_stop_the_run(store, feedback, rows, gate):
    run = Refresh(store, "1")
    with pytest.raises(GateFailure) as failure:
        run.run(feedback(*rows))
    assert failure.value.gate == gate
    assert [(r.step, r.status) for r in store.reports().collect()] == [("prepare", "FAILED")]
    assert store.head()["run_id"] == "bootstrap"


def test_failed_responses_do_not_lose_good_ones(store, feedback):
    with pytest.raises(GateFailure) as failure:
        Refresh(store, "1", flaky()).run(feedback(*ROWS))
    assert failure.value.gate == "responses" and store.cache().count() == 3
    assert store.stage("1", "failed_ai_responses").count() == 1
    run = Refresh(store, "2").run(feedback(*ROWS))
    assert run["analyze"]["ai_messages"] == 1 and store.cache().count() == 4


def test_repeated_step_keeps_the_answers_of_its_first_attempt(store, feedback):
    with pytest.raises(GateFailure):
        Refresh(store, "1", flaky()).run(feedback(*ROWS))
    again = Refresh(store, "1").run(feedback(*ROWS))
    assert again["analyze"]["ai_messages"] == 1 and again["analyze"]["processed"] == 4
    assert store.cache().count() == 4 and len(table(store)) == 4


def test_cache_is_read_once_and_only_where_keys_are(store, feedback, monkeypatch):
    Refresh(store, "1").run(feedback(*ROWS))
    changed = ROWS[1][:3] + ("The order is wrong",) + ROWS[1][4:]
    Refresh(store, "2").run(feedback(changed))
    key = feedback(ROWS[1]).select(cache_key().alias("_cache_key"))
    mine = key.select(cache_bucket(store.cache_buckets)).first()[0]
    # files of other buckets that cannot be read
    other = os.path.join(store.root, f"ai_answers/cut={store.cache_buckets}/by_run=x/part=x/bucket={(mine + 1) % store.cache_buckets}")
    os.makedirs(other)
    with open(os.path.join(other, "bad.parquet"), "wb") as f:
        f.write(b"not parquet")
    calls, read = [], Store.cache
    monkeypatch.setattr(Store, "cache", lambda self, buckets=None: calls.append(buckets) or read(self, buckets))
    back = Refresh(store, "3").run(feedback(ROWS[1]))
    assert back["analyze"]["ai_messages"] == 0 and back["analyze"]["processed"] == 1 and calls == [[mine]]
    with pytest.raises(Exception, match="bad.parquet"):
        read(store).collect()


def test_answers_cut_into_another_number_of_buckets_are_found(spark, store, feedback):
    Refresh(store, "1").run(feedback(*ROWS))
    changed = ROWS[1][:3] + ("The order is wrong",) + ROWS[1][4:]
    Refresh(store, "2").run(feedback(changed))
    other = Store(spark, store.root, store.buckets, cache_buckets=7)
    assert Refresh(other, "3").run(feedback(ROWS[1]))["analyze"]["ai_messages"] == 0


def test_concurrent_publication_is_refused(store, feedback):
    late = Refresh(store, "late")
    late.step("prepare", feedback(ROWS[0]))
    Refresh(store, "other").run(feedback(ROWS[1]))
    late.step("analyze")
    late.step("group")
    with pytest.raises(GateFailure) as failure:
        late.step("publish")
    assert failure.value.gate == "baseline" and set(table(store)) == {("support", "2")}


def test_replay_keeps_the_published_state(store, feedback):
    Refresh(store, "1").run(feedback(*ROWS))
    before, head = table(store), store.head()
    again = Refresh(store, "1").run(feedback(*ROWS))
    assert table(store) == before and store.head() == head
    assert again["publish"]["processed"] == 4 and again["analyze"]["ai_messages"] == 4


def test_saved_groups_stay(store, feedback):
    Refresh(store, "1").run(feedback(*ROWS))
    rows = store.read("feedback_with_issue_type").withColumn(
        "issue_type", F.when(F.col("issue_type") == "Late Delivery", "By hand").otherwise(F.col("issue_type")))
    path = store.write_version("feedback_with_issue_type", rows, "hand")
    store.commit("hand", store.head()["version"], store.head()["folders"] | {"feedback_with_issue_type": path})
    Refresh(store, "2").run(feedback(*ROWS))
    assert table(store)["support", "2"].issue_type == "By hand"


def test_rows_only_the_label_tables_hold_are_kept(store, feedback):
    Refresh(store, "1").run(feedback(*ROWS))
    path = store.write_version("feedback_clean", store.read("feedback_clean").where("source = 'support'"), "cut")
    store.commit("cut", store.head()["version"], store.head()["folders"] | {"feedback_clean": path})
    Refresh(store, "2").run(feedback(ROWS[0]))
    assert store.read("feedback_clean").count() == 2
    assert store.read("feedback_analyzed").count() == 4 and len(table(store)) == 4


def test_submissions_get_receipts(spark, store):
    import datetime as dt
    from echoloom import schemas as S
    sub = ("d0b34f11-5578-4a1f-a12b-2651092b1087", "Checkout payment failed", 1, "a", dt.datetime(2026, 1, 1),
           None, 0, None, None, None)
    subs = spark.createDataFrame([sub], S.SUBMISSIONS)
    got = submission_refresh(Refresh(store, "9"), subs).collect()
    assert len(got) == 1 and '"issue_type":"Payment/Checkout Failure"' in got[0].result
    assert '"run_id":"9"' in got[0].result and got[0].issue_key.startswith("issue-")
    missing = spark.createDataFrame([("nope",)], "id string")
    with pytest.raises(GateFailure):
        submission_refresh(Refresh(store, "10"), subs, missing)


def test_observer_failures_never_repeat_or_hide():
    calls, metrics = [], {}

    def once():
        calls.append(1)
        return "saved"

    def broken(_):
        raise RuntimeError("tracking unavailable")

    assert with_audit(once, broken, metrics) == "saved"
    assert calls == [1] and metrics == {"audit_warning": "RuntimeError"}

    def failing():
        calls.append(1)
        raise ValueError("write failed")

    with pytest.raises(ValueError):
        with_audit(failing, broken, {})
    assert calls == [1, 1]


def test_run_id_is_bound_to_its_input(store, feedback):
    Refresh(store, "1").run(feedback(ROWS[0]))
    Refresh(store, "1").run(feedback(ROWS[0]))                      # a replay
    with pytest.raises(ValueError, match="another input"):
        Refresh(store, "1").run(feedback(*ROWS))
    assert len(table(store)) == 1


def test_second_commit_on_one_parent_fails(store):
    store.commit("a", 0, store.head()["folders"])
    with pytest.raises(Conflict):
        store.commit("b", 0, store.head()["folders"])
    assert store.head()["run_id"] == "a" and store.read("feedback_clean", 1).count() == 0


def test_overlapping_runs_may_cache_one_answer_twice(store, feedback):
    Refresh(store, "1").run(feedback(*ROWS))
    store.append_cache(store.cache(), "overlap")
    changed = ROWS[1][:3] + ("The order is wrong",) + ROWS[1][4:]
    again = Refresh(store, "2").run(feedback(*ROWS[:1], changed))
    assert again["analyze"]["ai_messages"] == 1 and len(table(store)) == 4
    back = Refresh(store, "3").run(feedback(ROWS[1]))               # its answer is there twice
    assert back["analyze"]["ai_messages"] == 0 and table(store)["support", "2"].issue_type == "Late Delivery"


def test_all_evidence_is_published(store, feedback):
    rows = [("support", str(i), f"u{i}", f"Payment failed {i}", None, "2026-01-01") for i in range(150)]
    Refresh(store, "1").run(feedback(*rows))
    assert store.read("issue_evidence").agg(F.sum("messages")).first()[0] == 150
    assert store.read("issue_evidence").select(F.explode("example_messages.message").alias("m")).distinct().count() == 150


def test_rejected_labels_are_saved(store, feedback):
    make = keyword_model()

    class Odd:
        def predict(self, batch):
            out = make().predict(batch)
            out.loc[:, "sentiment"] = "odd"
            return out
    with pytest.raises(GateFailure):
        Refresh(store, "1", Odd).run(feedback(*ROWS))
    run = Refresh(store, "1")
    with_failures = [s for s in ("failed_ai_responses", "failed_analysis") if _exists(run, s)]
    assert with_failures


def _exists(run, name):
    try:
        return run.stage(name).count() > 0
    except Exception:
        return False


def test_bad_snapshot_is_refused(store, feedback):
    Refresh(store, "1").run(feedback(*ROWS))
    assert read_snapshot(store).count() == 4
    rows = store.read("feedback_with_issue_type")
    folders = dict(store.head()["folders"])
    for n, bad in enumerate((rows.unionByName(rows), rows.withColumn("sentiment", F.lit(None).cast("string")))):
        folders["feedback_with_issue_type"] = store.write_version("feedback_with_issue_type", bad, f"bad-{n}")
        store.commit(f"bad-{n}", store.head()["version"], folders)
        with pytest.raises(GateFailure):
            read_snapshot(store)
