"""Submission streams: incremental refresh, idempotency and rate limit."""

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from echoloom.operators.submissions import HOUR, payload_hash
from echoloom.plans.refresh import Refresh
from echoloom.plans.submissions import submission_refresh
from echoloom.tables import Store


def stream_refresh(submissions: DataFrame, store: Store, checkpoint: str, make_model=None,
                   prefix="stream"):
    """Each micro-batch is one refresh run. The batch ID is the run ID, so a replayed batch
    writes the same stages and receipts and is published once."""
    def process(batch: DataFrame, batch_id: int):
        submission_refresh(Refresh(store, f"{prefix}-{batch_id}", make_model), batch)

    return (submissions.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def stream_dedup(attempts: DataFrame, keep: str = "7 days", delay: str = "1 day") -> DataFrame:
    """Per ID: the payload that is kept, the attempts and whether another payload was posted.

    An ID is remembered until no attempt came for `keep`: it then closes, is emitted once
    (append mode) and leaves the state. A post of a closed ID is a new submission. Attempts
    older than the newest of all by more than `delay` are late: Spark leaves them out and
    counts them in the query's progress (`numRowsDroppedByWatermark`).

    The state holds the IDs that are open and those of a batch, so a batch of bounded size keeps it bounded; hashes are
    kept as bytes there, which order as their digits do.
    """
    posted = attempts.withWatermark("created_at", delay).select("id", "created_at", F.unhex(payload_hash()).alias("payload"))
    return posted.groupBy(F.session_window("created_at", keep), "id").agg(
        F.min(F.struct("created_at", "payload")).alias("kept"), F.count("*").alias("attempts"),
        (F.min("payload") != F.max("payload")).alias("conflict")) \
        .select("id", F.col("kept.created_at").alias("accepted_at"),
                F.lower(F.hex("kept.payload")).alias("payload"), "attempts", "conflict")


def stream_rate_limit(subs: DataFrame, store_path: str, checkpoint: str, limit: int = 10,
                      seconds: int = HOUR, delay: str = "1 day"):
    """Rate limit with a state per actor: the times accepted within the window, and the newest time.

    A batch costs what it holds; nothing that was decided is read again. A post older than the
    newest decided one of its actor is written with `late`, not accepted, so no window ever
    holds more than the limit. An actor is forgotten once the watermark is a window past the newest post.
    Posts older than the newest of all by more than `delay` are left out by the
    watermark and counted in the query's progress. A batch's posts of one actor are decided in one
    task; the source's options bound a batch.
    """
    width = seconds * 1_000_000
    names = subs.columns

    def decide(key, frames, state):
        if state.hasTimedOut:
            state.remove()
            return
        newest, taken = state.get if state.exists else (None, "")
        taken = deque(int(t) for t in taken.split(",") if t)
        rows = pd.concat(list(frames)).sort_values(["_at", "id"], kind="stable")
        at = rows.pop("_at").to_numpy()
        late = np.zeros(len(at), bool) if newest is None else at < newest
        accepted = np.zeros(len(at), bool)
        i, n = int(late.sum()), len(at)
        while i < n:
            while taken and taken[0] <= at[i] - width:
                taken.popleft()
            if len(taken) >= limit:
                # full: pass over all up to the one that frees a place
                i += max(1, int(np.searchsorted(at[i:], taken[0] + width)))
                continue
            accepted[i] = True
            taken.append(int(at[i]))
            i += 1
        newest = max(int(at[-1]), newest or int(at[-1]))
        state.update((newest, ",".join(map(str, taken))))
        state.setTimeoutTimestamp(max((newest + width) // 1000, state.getCurrentWatermarkMs()) + 1)
        yield rows[names].assign(accepted=accepted, late=late)

    fields = [*subs.schema.fields, T.StructField("accepted", T.BooleanType()), T.StructField("late", T.BooleanType())]
    decided = (subs.withColumn("_at", F.unix_micros("created_at")).withWatermark("created_at", delay).groupBy("created_by")
               .applyInPandasWithState(decide, T.StructType(fields), "newest LONG, taken STRING", "append", "EventTimeTimeout"))
    return (decided.writeStream.format("parquet").option("path", store_path).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
