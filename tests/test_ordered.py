import datetime as dt

import pytest
from pyspark.sql import functions as F

from echoloom import schemas as S
from echoloom.operators import issues, ordered
from echoloom.operators.ordered import Ordered, newest_first
from echoloom.tables import Store


@pytest.fixture(scope="module")
def rows(spark):
    """1,000 messages, two thirds of one second, some without a time; three issues, one of them without a category."""
    time = F.when(F.col("id") % 50 == 7, None).when(F.col("id") % 3 > 0, F.lit(dt.datetime(2026, 3, 1, 12))).otherwise(
        F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000))
    cat = F.when(F.col("id") % 10 == 0, "FEATURE_REQUEST").when(F.col("id") % 10 > 1, "BUG")
    return spark.range(1000).select(
        F.lit("s").alias("source"), F.format_string("%04d", (F.col("id") * 37) % 1000).alias("feedback_id"), time.alias("timestamp"),
        cat.alias("issue_cat"), F.when(F.col("id") % 10 == 9, None).otherwise("Checkout").alias("issue_type")).repartition(5)


def key(r):
    return (r.timestamp is None, -r.timestamp.timestamp() if r.timestamp else 0, r.source, r.feedback_id)


@pytest.mark.parametrize("per_range", [40, 10_000])
def test_slices_and_pages(spark, rows, tmp_path, per_range):
    stored = Ordered.write(rows, newest_first(), str(tmp_path / "o"), per_range)
    want = sorted(rows.collect(), key=key)
    assert stored.total() == 1000
    for skip, size in [(0, 1), (0, 25), (390, 25), (100, 300), (990, 25), (0, 2000), (1000, 5), (5, 0)]:
        assert stored.slice(skip, size).collect() == want[skip:skip + size]
    assert stored.page(0, 30).collect() == want[:30] and stored.page(99, 30).collect() == want[990:]
    again = Ordered(spark, str(tmp_path / "o"), rows.schema)
    assert again.page(14).collect() == want[325:350]


def test_a_page_opens_only_its_ranges_and_a_hot_second_is_cut(spark, rows, tmp_path):
    stored = Ordered.write(rows, newest_first(), str(tmp_path / "o"), 40)
    counts = stored.counts().orderBy("range_part").collect()
    assert len(counts) > 15 and max(c.n for c in counts) < 150       # 650 rows have one time
    page = stored.page(20)
    assert len(page.inputFiles()) <= 3 < len(stored._rows().inputFiles())


def test_positions_within_issues(spark, rows, tmp_path):
    got = issues.ordered_evidence(rows, str(tmp_path / "o"), 40).positions(within=issues.ISSUE).collect()
    want = {}
    for r in sorted((r for r in rows.collect() if r.issue_type), key=key):
        want.setdefault((r.issue_cat, r.issue_type), []).append(r.feedback_id)
    assert len(got) == 900 and len(want) == 3
    assert {(r.issue_cat, r.issue_type, r.position): r.feedback_id for r in got} == {
        (*k, i): f for k, ids in want.items() for i, f in enumerate(ids, 1)}


def test_ranges_stay_as_many_on_larger_tables(spark, rows, tmp_path, monkeypatch):
    """The borders of the ranges are chosen from a sample in one place, so much for each."""
    monkeypatch.setattr(ordered, "MOST", 6)
    stored = Ordered.write(rows, newest_first(), str(tmp_path / "o"), 10)
    assert 1 < stored.counts().count() <= 6 and stored.total() == 1000
    assert stored.slice(490, 30).collect() == sorted(rows.collect(), key=key)[490:520]


def test_empty_tables(spark, rows, tmp_path):
    stored = Ordered.write(rows.limit(0), newest_first(), str(tmp_path / "o"))
    assert stored.total() == 0 and stored.page(3).collect() == [] and stored.positions().collect() == []
    assert stored.page(1).schema.names == rows.columns


def test_a_version_is_ordered_once(spark, tmp_path):
    store = Store(spark, str(tmp_path)).bootstrap()
    assert store.pages().page(2).collect() == []
    first, again = store.pages(), store.pages()
    assert first.path == again.path and first.columns == S.PUBLISHED["feedback_with_issue_type"].names
