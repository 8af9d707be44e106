import datetime as dt

import pytest
from pyspark.sql import functions as F

from echoloom.operators import gates as G, incremental as I
from echoloom import schemas as S

ID = "d0b34f11-5578-4a1f-a12b-2651092b1087"


def test_submission_validation(spark):
    rows = [(ID.upper(), "  Payment fails every time.  ", 1), (ID, "A sufficiently long message.", None),
            (ID, "short", None), (ID, "x" * 2001, None), (ID, "Feedback with \0 null", None),
            (ID, None, None), (ID, "Feedback is valid.", 6), ("../etc", "Feedback is valid.", None)]
    df = spark.createDataFrame(rows, "id string, message string, rating int")
    got = G.validate_submissions(df).collect()
    assert [r.reason for r in got] == [None, None, "message length", "message length", "control characters",
                                       "no message", "rating", "invalid id"]
    assert got[0].id == ID and got[0].message == "Payment fails every time."


def test_decision_validation(spark):
    rows = [(" issue-1 ", "approved", "P9", "  ", "n" * 600), ("Bad key", "approved", "P1", "o", "n"),
            ("issue-2", "maybe", "P1", "o" * 90, None)]
    df = spark.createDataFrame(rows, "issue_key string, status string, priority string, owner string, note string")
    a, b, c = G.validate_decisions(df).collect()
    assert (a.reason, a.issue_key, a.priority, a.owner, len(a.note)) == (None, "issue-1", None, None, 600)
    assert b.reason == "issue key" and c.reason == "status" and len(c.owner) == 90


def test_conflicts_and_copies(feedback):
    t = dt.datetime(2026, 1, 1, 0, 0, 0, 123456)
    df = feedback(("a", "1", "u", "x", 1, t), ("a", "1", "u", "x", 1, t.replace(microsecond=123999)),
                  ("a", "2", "u", "x", 1, t), ("a", "2", "u", "y", 1, t), ("b", "1", "u", "x", 1, t))
    # Copies that differ below the millisecond are one payload.
    assert [(r.feedback_id, r.versions) for r in G.conflicting_payloads(df).collect()] == [("2", 2)]
    rows = {(r.source, r.feedback_id, r.message_text): r for r in I.dedupe(df).collect()}
    assert len(rows) == 4 and rows["a", "1", "x"]._copies == 2 and rows["a", "1", "x"].timestamp == t
    assert G.row(G.unique_keys(df)) == {"checked_rows": 5, "keys": 3, "duplicate_keys": 2, "empty_keys": 0}


def test_first_gate_in_order_is_raised():
    metrics = {}
    with pytest.raises(G.GateFailure) as failure:
        G.enforce({"a": 0, "b": 2, "c": 3}, {"a": "A", "b": "B", "c": "C"}, metrics)
    assert failure.value.gate == "b" and metrics["failed"] == 2


def test_empty_input_counts_zero(feedback):
    df = feedback()
    assert G.row(G.violations(df, bad=G.bad_record())) == {"checked_rows": 0, "bad": 0}
    assert G.row(G.unique_keys(df))["checked_rows"] == 0


def test_align_and_upsert(feedback):
    new = feedback(("a", "1", "u", "x", 1, "2026-01-01"), ("a", "2", "u", "y", 1, "2026-01-01"),
                   ("a", "3", "u", "z", 1, "2026-01-01"))
    old = feedback(("a", "1", "u", "x", 1, "2026-01-01"), ("a", "2", "u", "old", 1, "2026-01-01"),
                   ("a", "9", "u", "kept", 1, "2026-01-01"))
    rows = {r.feedback_id: r for r in I.align(new, old).collect()}
    assert {k: r._status for k, r in rows.items()} == {"1": "same", "2": "changed", "3": "new", "9": "retained"}
    assert rows["2"].message_text == "y" and rows["9"].message_text == "kept"
    once = I.upsert(old, new, S.KEYS, S.BASE)
    twice = I.upsert(once, new, S.KEYS, S.BASE)
    assert sorted(once.collect()) == sorted(twice.collect()) and once.count() == 4
    assert {r.feedback_id: r.change for r in I.record_diff(new, old, S.BASE).collect()} == {
        "2": "changed", "3": "added", "9": "removed"}


def test_reused_pending_and_retained_partition_the_keys(feedback):
    new = feedback(("a", "1", "u", "x", 1, "2026-01-01"), ("a", "2", "u", None, 2, "2026-01-01"),
                   ("a", "3", "u", "z", 1, "2026-01-01"))
    prior = feedback(("a", "1", "v", "x", 9, "2025-01-01"), ("a", "2", "u", None, 1, "2026-01-01"),
                     ("a", "3", "u", "older", 1, "2026-01-01")).withColumns(
        {c: F.lit(None).cast(t) for c, t in S.LABEL_FIELDS})
    reused, pending = I.reuse_labels(new, prior).collect(), I.pending(new, prior).collect()
    assert sorted(r.feedback_id for r in reused) == ["1", "2"]     # NULL text equals NULL text
    assert [r.feedback_id for r in pending] == ["3"]
    assert {r.feedback_id: r.rating for r in reused} == {"1": 1, "2": 2}   # current columns


def test_long_owner_and_note_are_kept_or_refused(spark):
    forms = spark.createDataFrame([("issue-" + "a" * 24, "approved", "P1", "o" * 200, "n" * 900)],
                                  "issue_key string, status string, priority string, owner string, note string")
    kept = G.validate_decisions(forms).first()
    assert (len(kept.owner), len(kept.note)) == (200, 900)
    assert G.validate_decisions(forms, owner_size=80).first().reason == "owner length"
    assert G.validate_decisions(forms, note_size=500).first().reason == "note length"
