"""Row fingerprints and stable keys."""

from pyspark.sql import Column, functions as F

from echoloom.functions import rules as R
from echoloom.functions.text import web_trim
from echoloom.schemas import KEYS


def fingerprint(cols) -> Column:
    """Hash of the row as JSON. Timestamps enter with millisecond precision."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def cache_key(version: str = R.CLASSIFIER_VERSION) -> Column:
    return F.sha2(F.concat_ws("|", fingerprint(KEYS + ["message_text"]), F.lit(version)), 256)


def _json_pair(a, b) -> Column:
    return F.to_json(F.array(a, b))


def issue_key(cat="issue_cat", name="issue_type") -> Column:
    return F.concat(F.lit("issue-"), F.substring(F.sha2(_json_pair(cat, name), 256), 1, 24))


def row_issue_key() -> Column:
    """Issue key of a feedback row; NULL when the row belongs to no issue."""
    name = F.col("issue_type")
    key = issue_key(F.coalesce("issue_cat", "category"), name)
    return F.when(name.isNotNull() & (name != ""), key)


def reporter_key() -> Column:
    return F.when(web_trim("user_id") != "", _json_pair("source", "user_id"))


def reporter_struct() -> Column:
    """(source, user) as the pipeline counts it: NULL for a missing or blank user."""
    user = F.col("user_id")
    return F.when(user.isNotNull() & (F.trim(user) != ""), F.struct("source", "user_id"))
