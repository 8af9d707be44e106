"""Quality review of saved labels; never reclassifies."""

from typing import Protocol

import pandas as pd

from pyspark.sql import Column, DataFrame, functions as F

from echoloom import schemas as S
from echoloom.operators.issues import first_per_group

STRATUM = ["category", "uncertain_classification"]


def _app_first() -> Column:
    return F.when(F.col("source") == "app_submission", 0).otherwise(1)


def sample_rank(df: DataFrame, n: int) -> DataFrame:
    """The first n rows per (category, flagged): app submissions first, then by key hash."""
    key_hash = F.sha2(F.concat("source", F.lit("|"), "feedback_id"), 256)
    return first_per_group(df, STRATUM, [_app_first(), key_hash], n, "sample_rank")


def texts_now(current: DataFrame, sample: DataFrame) -> DataFrame:
    """Today's texts of the sampled messages. The sample has a known bound, so the texts of all others stay where they are."""
    return current.join(sample.select(*S.KEYS), S.KEYS, "left_semi").select(*S.KEYS, F.col("message_text").alias("_now"))


def quality_sample(df: DataFrame, n: int = 20) -> DataFrame:
    """n varied rows. Only ranks up to n can be among them."""
    return sample_rank(df, n).orderBy("sample_rank", _app_first(), "category",
                                      F.col("uncertain_classification").desc()).limit(n)


class Judge(Protocol):
    def assess(self, batch: pd.DataFrame) -> pd.DataFrame:
        """Long form: columns scorer, passed, reason next to source and feedback_id."""


def judge_rows(sample: DataFrame, scorers: dict) -> DataFrame:
    """One row per (message, scorer). `scorers` maps a name to a boolean expression."""
    verdicts = F.array(*[F.struct(F.lit(name).alias("scorer"), ok.alias("passed"))
                         for name, ok in scorers.items()])
    return sample.select(*sample.columns, F.explode(verdicts).alias("_v")) \
        .select(*sample.columns, "_v.scorer", "_v.passed")


def judge_batches(sample: DataFrame, make_judge) -> DataFrame:
    """The same with a batch judge, created once per task."""
    def run(batches):
        judge = make_judge()
        for batch in batches:
            yield judge.assess(batch)[["source", "feedback_id", "scorer", "passed", "reason"]]

    return sample.mapInPandas(run, "source string, feedback_id string, scorer string, "
                                   "passed boolean, reason string")


def pass_rates(judged: DataFrame) -> DataFrame:
    return judged.groupBy("scorer").agg(
        F.count("*").alias("judged"), F.count(F.when(F.col("passed"), 1)).alias("passed"),
        F.avg(F.col("passed").cast("double")).alias("pass_rate"))


def model_judge(make_model):
    """A batch judge from a labelling model: is a saved label what the model says of the text?"""
    class ModelJudge:
        def __init__(self):
            self.model = make_model()

        def assess(self, batch: pd.DataFrame) -> pd.DataFrame:
            answer = self.model.predict(batch)
            parts = []
            for scorer, saved, wanted in (("category_supported", "category", "value"),
                                          ("sentiment_supported", "sentiment", "sentiment"),
                                          ("explanation_grounded", "explanation", "rationale")):
                passed = batch[saved].to_numpy() == answer[wanted].to_numpy()
                parts.append(batch[["source", "feedback_id"]].assign(
                    scorer=scorer, passed=passed, reason=[None if p else f"the text says {w}"
                                                          for p, w in zip(passed, answer[wanted])]))
            return pd.concat(parts)

    return ModelJudge
