"""Labelling: keyword rules as one expression, or a batch model over Arrow batches."""

from typing import Protocol

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from echoloom import schemas as S
from echoloom.functions import labels, rules as R

SCORED = ("_cache_key string, value string, confidence_score double, rationale string, "
          "sentiment string, error_message string")


class Model(Protocol):
    def predict(self, batch: pd.DataFrame) -> pd.DataFrame:
        """Columns value, confidence_score, rationale, sentiment, error_message, in row order."""


def score(df: DataFrame, make_model) -> DataFrame:
    """Run a model over (_cache_key, message_text); `make_model` is called once per task.

    Texts are passed whole. A task that is retried calls the model again, so write the
    result once and read it back (see plans.refresh).
    """
    def run(batches):
        model = make_model()
        for batch in batches:
            out = model.predict(batch)
            out.insert(0, "_cache_key", batch["_cache_key"].to_numpy())
            yield out[["_cache_key", "value", "confidence_score", "rationale", "sentiment",
                       "error_message"]]

    return df.select("_cache_key", "message_text").mapInPandas(run, SCORED)


def keyword_scores(df: DataFrame) -> DataFrame:
    """The offline labeller; stays in generated code."""
    return labels.with_keyword_label(df).select(
        "_cache_key", "_label.*", "sentiment", F.lit(None).cast("string").alias("error_message"))


def classify(df: DataFrame, make_model=None) -> DataFrame:
    """Responses as the cache stores them: one JSON document per message."""
    scored = keyword_scores(df) if make_model is None else score(df, make_model)
    answer = F.struct("value", "confidence_score", "rationale")
    response = F.struct(F.array(answer).alias("response"), F.col("error_message"))
    return scored.select("_cache_key",
                         F.to_json(response, {"ignoreNullFields": "false"}).alias("classification_json"),
                         "sentiment", F.current_timestamp().alias("classified_at"))


def sentiment(df: DataFrame) -> DataFrame:
    return labels.with_sentiment(df)


def parse_response(df: DataFrame) -> DataFrame:
    parsed = df.withColumn("_parsed", F.from_json("classification_json", S.AI_RESPONSE))
    first = F.get(F.col("_parsed.response"), F.lit(0))
    return parsed.select(*df.columns, first["value"].alias("value"),
                         first["confidence_score"].alias("score"),
                         first["rationale"].alias("rationale"),
                         F.col("_parsed.error_message").alias("error_message"))


def response_ok() -> Column:
    ok = (F.col("value").isin(list(S.CATEGORIES)) & F.col("score").between(0, 1)
          & (F.length(F.trim("rationale")) > 0) & F.col("sentiment").isin(S.SENTIMENTS)
          & F.col("error_message").isNull())
    return F.coalesce(ok, F.lit(False))


def split_responses(df: DataFrame):
    """(valid, failed) responses, with the columns of the input."""
    checked = parse_response(df).withColumn("_ok", response_ok())
    return (checked.where("_ok").select(*df.columns), checked.where("not _ok").select(*df.columns))


def extract_labels(df: DataFrame) -> DataFrame:
    """Label columns read from the saved JSON, each document parsed once."""
    keep = [c for c in df.columns if c in S.BASE or c == "_cache_key"]
    return parse_response(df).select(
        *keep, F.col("value").alias("category"), F.col("score").alias("confidence_score"),
        F.col("rationale").alias("explanation"), "sentiment",
        F.lit(False).alias("uncertain_classification"))


def keyword_model():
    """`make_model` for the keyword labeller behind the batch interface.

    Rules and class travel with the task, so workers need no copy of this package.
    """
    rules, default = R.CATEGORY_RULES, R.CATEGORY_DEFAULT
    words = [labels.word_pattern(w) for w in (R.POSITIVE_WORDS, R.NEGATIVE_WORDS)]

    class KeywordModel:
        def __init__(self):
            self.answers = [answer for _, *answer in rules] + [list(default)]

        def hits(self, texts, pattern):
            """One mask per pattern; patterns are in lower case."""
            spaces = pattern.replace("\\s", "[\\t\\n\\v\\f\\r ]")
            return pc.match_substring_regex(texts, spaces).to_numpy(zero_copy_only=False)

        def predict(self, batch: pd.DataFrame) -> pd.DataFrame:
            texts = pc.ascii_lower(pa.array(batch["message_text"], pa.large_string(), from_pandas=True).fill_null(""))
            masks = [self.hits(texts, p) for p, *_ in rules]
            first = np.select(masks, range(len(masks)), len(masks))
            out = pd.DataFrame({name: np.array([a[i] for a in self.answers], object)[first]
                                for i, name in enumerate(("value", "confidence_score", "rationale"))})
            out["confidence_score"] = out["confidence_score"].astype(float)
            good, bad = [self.hits(texts, w) for w in words]
            out["sentiment"] = np.select([good & bad, good, bad], ["mixed", "positive", "negative"],
                                         "neutral")
            out["error_message"] = None
            return out

    return KeywordModel
