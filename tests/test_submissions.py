import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from echoloom.operators import submissions as U
from echoloom.session import scratch
from echoloom.streaming.submissions import stream_dedup, stream_rate_limit
from echoloom.streaming.trends import stream_weekly, stream_weeks

T0 = dt.datetime(2026, 1, 1, 7)


def brute_limit(rows, limit, seconds):
    taken, out = {}, {}
    for key, actor, at in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        mine = taken.setdefault(actor, [])
        ok = sum(1 for a in mine if a > at - dt.timedelta(seconds=seconds)) < limit
        if ok:
            mine.append(at)
        out[key] = ok
    return out


def posts(seed, n=300, actors=3, span=6 * 3600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        burst = rng.choice([span, span, 600])         # one part of the posts comes in a burst
        at = T0 + dt.timedelta(seconds=rng.randrange(burst), microseconds=rng.choice([0, 0, 1, 500000]))
        rows.append((f"{i:04d}", f"actor{min(rng.randrange(actors + 2), actors)}", at))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id string, created_by string, created_at timestamp")


@pytest.mark.parametrize("seed, n, limit", [(1, 300, 10), (2, 60, 3), (3, 900, 10), (4, 40, 1)])
def test_rate_limit_is_exact(spark, seed, n, limit):
    rows = posts(seed, n)
    got = {r.id: r.accepted for r in U.rate_limit(frame(spark, rows), limit).collect()}
    assert got == brute_limit(rows, limit, 3600)


def test_rate_limit_edge_of_the_window(spark):
    rows = [(str(i), "a", T0) for i in range(10)] + [("x", "a", T0 + dt.timedelta(seconds=3599, microseconds=999999)),
                                                     ("y", "a", T0 + dt.timedelta(hours=1))]
    got = {r.id: r.accepted for r in U.rate_limit(frame(spark, rows)).collect()}
    assert not got["x"] and got["y"] and sum(got.values()) == 11


def test_hourly_count_is_exact(spark):
    rows = posts(5)
    got = {(r.created_by, r.created_at): (r.submissions, r.earlier) for r in U.hourly_count(frame(spark, rows)).collect()}
    for (actor, at), (n, earlier) in got.items():
        mine = [t for _, a, t in rows if a == actor]
        assert n == mine.count(at)
        assert earlier == sum(1 for t in mine if at - dt.timedelta(hours=1) < t < at)
    assert len(got) == len({(a, t) for _, a, t in rows})


def test_stream_rate_limit_over_batches(spark):
    rows = sorted(posts(6), key=lambda r: (r[2], r[0]))
    source, out = scratch(spark, "in"), scratch(spark, "out")
    cut = next(i for i in range(150, len(rows)) if rows[i][2] > rows[i - 1][2])
    for part in (rows[:cut], rows[cut:]):
        frame(spark, part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id string, created_by string, created_at timestamp").parquet(source)
        stream_rate_limit(stream, out, f"{out}-ckpt").awaitTermination()
    got = {r.id: r.accepted for r in spark.read.parquet(out).collect()}
    assert got == brute_limit(rows, 10, 3600)


def test_latest_attempt(spark):
    rows = [(1, "prepare", 1, 0, "RUNNING", None), (1, "prepare", 0, 1, None, "FAILED"),
            (2, "prepare", None, 0, None, "FAILED"), (2, "prepare", None, 1, None, None)]
    df = spark.createDataFrame(rows, "run_id int, task_key string, attempt_number int, seq int, "
                                     "life_cycle_state string, result_state string")
    assert {r.run_id: r.state for r in U.latest_task_state(df).collect()} == {1: "RUNNING", 2: "PENDING"}


def test_idempotency(spark):
    rows = [("1", "a", "m", 1, T0), ("1", "a", "m", 1, T0 + dt.timedelta(1)), ("1", "a", "other", 1, T0 + dt.timedelta(2)),
            ("2", "a", "m", None, T0)]
    df = spark.createDataFrame(rows, "id string, created_by string, message string, rating int, created_at timestamp")
    got = {r.id: (r.attempts, r.replays, r.conflicts) for r in U.idempotent(df).collect()}
    assert got == {"1": (3, 1, 1), "2": (1, 0, 0)}


def test_status(spark):
    subs = spark.createDataFrame([("a", 1, "{}", None), ("b", 2, None, None), ("c", 3, None, None), ("d", None, None, "x")],
                                 "id string, run_id long, result string, dispatch_error string")
    runs = spark.createDataFrame([(1, "TERMINATED", "SUCCESS"), (2, "INTERNAL_ERROR", None), (3, "RUNNING", None)],
                                 "run_id long, life_cycle_state string, result_state string")
    got = {r.id: (r.status, r.can_retry) for r in U.submission_status(subs, runs).collect()}
    assert got == {"a": ("completed", False), "b": ("failed", True), "c": ("processing", False), "d": ("saved", True)}


def test_late_posts_never_break_the_limit(spark):
    """Ten posts at 07:30, then ten at 07:10 in the next batch: the late ones are reported, not accepted."""
    folder, out = scratch(spark, "late-in"), scratch(spark, "late-out")
    late = T0 + dt.timedelta(minutes=10)
    for minutes in (30, 10):
        rows = [(f"{minutes}-{i}", "a", T0 + dt.timedelta(minutes=minutes)) for i in range(10)]
        spark.createDataFrame(rows, "id string, created_by string, created_at timestamp").coalesce(1) \
            .write.mode("append").parquet(folder)
        stream = spark.readStream.schema("id string, created_by string, created_at timestamp").parquet(folder)
        stream_rate_limit(stream, out, f"{out}-ckpt").awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 20 and got.where("accepted").count() == 10
    assert got.where("late AND NOT accepted").count() == 10


def feed(spark, schema, batches, start):
    """Batches through one stream, a file each; returns the progress of every micro-batch."""
    folder = scratch(spark, "feed")
    spark.createDataFrame([], schema).write.parquet(folder)
    progress = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        query = start(spark.readStream.schema(schema).parquet(folder))
        query.awaitTermination()
        progress.append(query.recentProgress)
    return progress


def appended(stream, out):
    return (stream.writeStream.format("parquet").option("path", out).outputMode("append")
            .option("checkpointLocation", f"{out}-ckpt").trigger(availableNow=True).start())


def test_stream_ids_expire(spark):
    """IDs close seven days after their last attempt, leave the state, and may then be used anew."""
    day = lambda n: T0 + dt.timedelta(days=n)
    schema, out = "id string, created_by string, message string, rating int, created_at timestamp", scratch(spark, "ids")
    batches = [[("1", "a", "m", 1, day(0)), ("1", "a", "other", 1, day(1)), ("2", "a", "m", 1, day(2))],
               [("1", "a", "m", 1, day(7)), ("3", "b", "m", 1, day(30))],
               [("1", "a", "again", 1, day(40)), ("2", "a", "late", 1, day(3)), ("4", "b", "m", 1, day(60))]]
    progress = feed(spark, schema, batches, lambda s: appended(stream_dedup(s), out))
    got = sorted((r.id, r.accepted_at, r.attempts, r.conflict) for r in spark.read.parquet(out).collect())
    assert got == [("1", day(0), 3, True), ("1", day(40), 1, False), ("2", day(2), 1, False), ("3", day(30), 1, False)]
    kept = [p[-1]["stateOperators"][0]["numRowsTotal"] for p in progress]
    assert kept == [2, 1, 1]                         # only the open IDs
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress[2]) == 1


def test_stream_actors_are_forgotten(spark):
    """The state holds the actors of the last window; the result is that of the batch operator."""
    out, rows = scratch(spark, "forget"), []
    for d in range(4):
        rows.append([(f"{d}-{i:02d}", f"actor{d}-{i % 3}", T0 + dt.timedelta(days=3 * d, minutes=i)) for i in range(45)])
    progress = feed(spark, "id string, created_by string, created_at timestamp", rows,
                    lambda s: stream_rate_limit(s, out, f"{out}-ckpt", limit=4))
    got = {r.id: r.accepted for r in spark.read.parquet(out).collect()}
    assert got == brute_limit([r for batch in rows for r in batch], 4, 3600)
    assert progress[-1][-1]["stateOperators"][0]["numRowsTotal"] == 3


def test_stream_weeks_close_once(spark):
    at = lambda n: T0 + dt.timedelta(days=n)
    out = scratch(spark, "weeks")
    batches = [[("negative", at(0)), ("positive", at(6))], [("negative", at(2)), ("mixed", at(30))], [("mixed", at(1)), ("mixed", at(60))]]
    progress = feed(spark, "sentiment string, timestamp timestamp", batches, lambda s: appended(stream_weekly(s), out))
    got = {str(r.week): (r.positive, r.negative, r.mixed) for r in spark.read.parquet(out).collect()}
    assert got == {"2025-12-29": (0, 2, 0), "2026-01-05": (1, 0, 0), "2026-01-26": (0, 0, 1)}
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress[2]) == 1


def test_stream_weeks_leaves_no_message_out(spark):
    """Open weeks, late messages and those without a time."""
    at = lambda n: T0 + dt.timedelta(days=n)
    out, last = scratch(spark, "all-weeks"), []
    batches = [[("negative", at(0)), ("positive", None)], [("mixed", at(30))], [("mixed", at(1)), ("mixed", at(60))]]
    feed(spark, "sentiment string, timestamp timestamp", batches, lambda s: stream_weeks(s).writeStream.outputMode("complete").foreachBatch(
        lambda b, i: last.append(b.collect())).option("checkpointLocation", f"{out}-ckpt").trigger(availableNow=True).start())
    got = {str(r.week): (r.positive, r.negative, r.mixed) for r in last[-1]}
    assert got == {"None": (1, 0, 0), "2025-12-29": (0, 1, 1), "2026-01-26": (0, 0, 1), "2026-03-02": (0, 0, 1)}


def test_hourly_count_is_one_running_sum(spark):
    """A frame that slides by time adds up all of a window anew for every row."""
    rows = [(str(i), "a", T0 + dt.timedelta(seconds=i % 50)) for i in range(100)] + [("x", "a", None), ("y", None, T0), ("z", None, T0)]
    counted = U.hourly_count(frame(spark, rows))
    text = counted._jdf.queryExecution().executedPlan().toString().lower()
    assert "rowframe" in text and "rangeframe" not in text
    got = {(r.created_by, r.created_at): (r.submissions, r.earlier) for r in counted.collect()}
    assert got == {("a", T0 + dt.timedelta(seconds=i)): (2, 2 * i) for i in range(50)} | {(None, T0): (2, 0)}


def test_receipts_complete_submissions_once(spark):
    subs = spark.createDataFrame([("1", None, None, "busy"), ("2", '{"a":1}', T0, None), ("3", None, None, "x")],
                                 "id string, result string, completed_at timestamp, dispatch_error string")
    done = spark.createDataFrame([("1", '{"b":2}'), ("2", '{"c":3}')], "id string, result string")
    at = F.lit(T0 + dt.timedelta(days=1))
    once = U.apply_receipts(subs, done, at)
    again = U.apply_receipts(once, done, at + F.make_dt_interval(days=F.lit(1)))
    got = {r.id: r for r in again.collect()}
    assert got["1"].result == '{"b":2}' and got["1"].completed_at == T0 + dt.timedelta(days=1)
    assert got["1"].dispatch_error is None and got["2"].result == '{"a":1}' and got["2"].completed_at == T0
    assert got["3"].result is None and got["3"].dispatch_error == "x"


def test_a_stream_is_cut_into_batches_of_bounded_size(spark):
    """However many posts there are, the state holds those of a batch; results stay those of all posts."""
    from echoloom.sources import samples as Z
    folder, out = scratch(spark, "posts"), scratch(spark, "bounded")
    rows = [(str(i), "a", f"m{i}", 1, T0 + dt.timedelta(days=i)) for i in range(600)] + [("7", "a", "other", 1, T0 + dt.timedelta(days=9))]
    schema = "id string, created_by string, message string, rating int, created_at timestamp"
    spark.createDataFrame([*rows, ("no time", "a", "m", 1, None)], schema).write.parquet(f"{folder}/posts.parquet")
    stream = Z.stream(spark, folder, "posts", "created_at", per_batch=60)
    query = appended(stream_dedup(stream), out)
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert len(batches) >= 10 and sum(p["numInputRows"] for p in batches) == len(rows) + 1
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) < 200      # 400 and more in three batches
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress) == 0
    got = {r.id: (r.accepted_at, r.attempts, r.conflict, len(r.payload)) for r in spark.read.parquet(out).collect()}
    assert got == {str(i): (T0 + dt.timedelta(days=i), 1 + (i == 7), i == 7, 64) for i in range(592)}
