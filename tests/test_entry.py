"""The registered queries against DuckDB, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, duck

SF = "/root/testdata/sf0.001"
FAST = ["scan_csv_export", "normalize_in_app", "mask_contacts", "classify_feedback", "issue_type_rules", "record_diff", "issue_summary",
        "issue_examples", "issue_groups", "page_by_index", "evidence_in_order", "weekly_sentiment", "dedupe_by_key", "hourly_submission_count", "rate_limit",
        "submission_idempotency", "validate_submissions", "decision_upsert", "publish_result", "stream_dedup"]


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 95


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, name):
    message, ok = compare(spark, duck(SF), name, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert ok, message


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
