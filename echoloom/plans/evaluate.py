"""Quality evaluation of saved labels at a pinned version."""

from pyspark.sql import DataFrame, functions as F

from echoloom import schemas as S
from echoloom.operators import ai, quality as Q
from echoloom.tables import Store


def evaluate(store: Store, version: int, current: DataFrame, make_judge=None, n: int = 20) -> DataFrame:
    """Judge a varied sample of the labels that `version` published against the current texts.

    Saved labels are judged, never replaced. A message that `current` lacks is judged by its saved text.
    """
    sample = Q.quality_sample(store.read("feedback_with_issue_type", version), n)
    now = Q.texts_now(current, sample)
    judged = sample.join(now, S.KEYS, "left").withColumn("message_text", F.coalesce("_now", "message_text")).drop("_now")
    return Q.pass_rates(Q.judge_batches(judged, make_judge or Q.model_judge(ai.keyword_model())))
