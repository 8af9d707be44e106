"""Physical plans: nothing leaves generated code, nothing is paired without a key."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from echoloom import schemas as S
from echoloom.operators import explore, incremental as I, issues, quality as Q
from echoloom.operators.explore import Filter
from echoloom.sources import samples as Z


@pytest.fixture
def rows(spark, store):
    path = f"{store.root}/rows"
    spark.createDataFrame([], S.GROUPED).write.parquet(path)
    return spark.read.schema(S.GROUPED).parquet(path)


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_relational_paths_have_no_python_and_no_pairs(rows):
    for df in [I.align(rows, rows), I.reuse_labels(rows, rows), I.pending(rows, rows), I.dedupe(rows),
               I.record_diff(rows, rows, S.BASE), I.upsert(rows, rows, S.KEYS, S.BASE), issues.issue_summary(rows),
               issues.issue_examples(rows), issues.issue_groups(rows), issues.assign(rows), explore.overview(rows)]:
        text = plan(df)
        for bad in ("Python", "ArrowEval", "MapInPandas", "CartesianProduct", "NestedLoop"):
            assert bad not in text


def test_issue_filter_reaches_the_scan(spark, rows):
    groups = spark.createDataFrame([("issue-1", "Late Delivery", "COMPLAINT_DELIVERY")], "key string, name string, category string")
    text = plan(explore.filter_feedback(rows, Filter(issue="issue-1"), groups))
    assert "EqualTo(issue_type,Late Delivery)" in text
    assert "EqualTo(issue_type,Late Delivery)" in plan(issues.evidence(rows, "issue-1", groups))


def test_overview_expands_no_rows(rows):
    assert "Expand" not in plan(explore.overview(rows))


def test_ranks_are_limited_before_the_shuffle(rows):
    assert plan(issues.top_messages(rows, 5)).count("WindowGroupLimit") >= 4
    assert "WindowGroupLimit" in plan(Q.sample_rank(rows, 20))


def test_whole_rows_are_neither_sorted_nor_shuffled_to_find_the_first(rows):
    """Places are found on the order's columns; texts meet them in a broadcast join."""
    for df in [issues.top_messages(rows, 5), Q.sample_rank(rows, 20)]:
        text = plan(df)
        assert "BroadcastHashJoin LeftSemi" in text
        wide = text[text.index("BroadcastHashJoin LeftSemi"):].split("BroadcastExchange")[0]
        assert "Scan parquet" in wide and "Exchange" not in wide and "Sort" not in wide
    small = Q.quality_sample(rows, 20)
    assert "BroadcastHashJoin LeftSemi" in plan(Q.texts_now(rows, small))


def test_first_per_group_keeps_ties_nulls_and_late_times(feedback):
    rows = feedback(*[("s", k, "u", "t", 1, f"2026-01-01 00:00:0{i}") for i, k in enumerate("abc")],
                    ("s", "c", "u", "again", 1, "2026-01-01 00:00:02")) \
        .withColumns({"timestamp": F.when(F.col("feedback_id") != "b", F.col("timestamp")), "issue_cat": F.lit(None).cast("string"),
                      "issue_type": F.lit("x")})
    got = lambda n: [(r["feedback_id"], r["rank"]) for r in issues.top_messages(rows, n).orderBy("rank").collect()]
    assert got(2) == [("c", 1), ("c", 2)] and got(3)[2] == ("a", 3) and got(9)[3] == ("b", 4)
    assert got(1) == [("c", 1)]


def test_evidence_joins_only_large_days(feedback):
    rows = feedback(*[("s", str(i), "u", "t", 1, f"2026-01-0{1 + i // 3} 00:00:00") for i in range(4)]) \
        .withColumns({"issue_cat": F.lit(None).cast("string"), "issue_type": F.lit("x"), "confidence_score": F.lit(0.5), "sentiment": F.lit("mixed")})
    seen = []
    chunks = issues.issue_examples(rows, per_row=2, keep=lambda p: seen.append(p) or p).collect()
    assert seen[0].count() == 1     # the first day has two parts, the second day one and no row to join
    assert sorted((r["day"].day, r["parts"]) for r in chunks)[-1] == (2, 1) and sum(r["messages"] for r in chunks) == 4


def test_day_and_source_filters_reach_the_scan(rows):
    df = explore.filter_feedback(rows, Filter(start="2026-01-01", end="2026-01-31", source="support"))
    pushed = next(line for line in plan(df.select("feedback_id")).splitlines() if "PushedFilters" in line)
    assert "GreaterThanOrEqual(timestamp" in pushed and "EqualTo(source,support)" in pushed


def test_totals_read_only_their_columns(rows):
    schema = next(line for line in plan(issues.issue_totals(rows)).splitlines() if "ReadSchema" in line)
    assert "message_text" not in schema and "explanation" not in schema


def test_pages_use_a_bounded_sort(rows):
    assert "TakeOrderedAndProject" in plan(explore.order_evidence(rows).offset(50).limit(25))


def test_samples_spread_by_key_and_join_names_first(spark, feedback, tmp_path):
    """Spreading sorts nothing; order lines meet reviews that have their names."""
    text = plan(Z.spread(feedback()))
    assert "hashpartitioning(source" in text and "roundrobin" not in text.lower()
    spark.sql("select 1L o_orderkey, 7L o_custkey, 'F' o_orderstatus, '3-X' o_orderpriority, timestamp'2026-01-01' o_orderdate"
              " union all select 2L, 7L, 'F', '1-X', timestamp'2026-01-02'").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("select 7L c_custkey, 'n' c_name, 3 c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("select explode(array(1L, 1L, 2L, 9L)) l_orderkey").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = Z.google_play_reexported(spark, str(tmp_path))
    assert sorted(r.reviewId for r in rows.collect()) == ["1", "1", "2"]
    joins = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert "o_orderkey" in joins[0] and "o_custkey" in joins[1]
