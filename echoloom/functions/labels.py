"""Review flag, issue rules, keyword labels and display labels."""

from pyspark.sql import Column, DataFrame, functions as F

from echoloom import schemas as S
from echoloom.functions import rules as R
from echoloom.functions.text import ascii_lower, web_trim


def review_flag() -> Column:
    """The pipeline's flag: sticky, and NaN scores are not flagged."""
    score = F.col("confidence_score")
    return (F.coalesce("uncertain_classification", F.lit(False)) | score.isNull()
            | F.coalesce(_below(score), F.lit(False))
            | F.col("explanation").isNull() | (F.trim("explanation") == ""))


def web_review_flag() -> Column:
    """The read side's flag: blank means blank in a browser; needs a finite-or-NULL score."""
    score = F.col("confidence_score")
    return (F.coalesce("uncertain_classification", F.lit(False)) | score.isNull()
            | F.col("explanation").isNull() | (web_trim("explanation") == "")
            | F.coalesce(_below(score), F.lit(False)))


def _below(score: Column) -> Column:
    return (score < S.REVIEW_BELOW) & ~F.isnan(score)


# Rules are matched on a lower-cased copy of the text, made once per row as a column of its
# own: plain alternatives are then byte searches instead of regular expressions. The rule
# tables become one SQL CASE each.

def with_ascii(df: DataFrame, only: Column = None) -> DataFrame:
    """Adds `_ascii`, the lower-cased message; `only` limits the work to the rows that need it."""
    text = ascii_lower(F.coalesce("message_text", F.lit("")))
    return df.withColumn("_ascii", text if only is None else F.when(only, text))


def _hit(pattern: str) -> str:
    if set(pattern) & set("^()"):
        return f"rlike(_ascii, r'{pattern}')"
    return " OR ".join(_alternative(part) for part in pattern.split("|"))


def _alternative(part: str) -> str:
    literal = part.replace("\\.", ".")
    if set(literal.replace(".", "")) & set("\\?*+[]{}$") or (literal == part and "." in part):
        return f"rlike(_ascii, r'{part}')"
    return f"contains(_ascii, '{literal}')"


def _case(branches, fallback) -> str:
    whens = " ".join(f"WHEN {condition} THEN {value}" for condition, value in branches)
    return f"CASE {whens} ELSE {fallback} END"


def has_rules() -> Column:
    return F.col("category").isin(list(R.ISSUE_RULES))


def issue_type() -> Column:
    """Needs `_ascii`. Only the rule family of the row's category is evaluated."""
    families = [(f"category = '{category}'",
                 _case([(_hit(p), f"'{name}'") for p, name in rules],
                       f"'{R.ISSUE_FALLBACK[category]}'"))
                for category, rules in R.ISSUE_RULES.items()]
    families += [(f"category = '{c}'", f"'{name}'") for c, name in R.ISSUE_CONSTANT.items()]
    return F.expr(_case(families, "NULL"))


def with_issue_type(df: DataFrame) -> DataFrame:
    return with_ascii(df, has_rules()).withColumn("issue_type", issue_type()).drop("_ascii")


def issue_cat() -> Column:
    c, expr = F.col("category"), F
    for category, name in R.ISSUE_CATEGORY.items():
        expr = expr.when(c == category, F.lit(name))
    return expr.when(F.col("issue_type").isNotNull(), c)


def with_keyword_label(df: DataFrame) -> DataFrame:
    """Adds `_label`, the struct (value, confidence_score, rationale) of the first category
    rule that matches, and `sentiment`."""
    label = _case([(_hit(p), _label(*answer)) for p, *answer in R.CATEGORY_RULES],
                  _label(*R.CATEGORY_DEFAULT))
    return with_ascii(df).withColumns({"_label": F.expr(label), "sentiment": _sentiment()}) \
        .drop("_ascii")


def _label(value, score, why) -> str:
    return (f"named_struct('value', '{value}', 'confidence_score', {score}D, "
            f"'rationale', '{why}')")


def with_sentiment(df: DataFrame) -> DataFrame:
    return with_ascii(df).withColumn("sentiment", _sentiment()).drop("_ascii")


def _sentiment() -> Column:
    good, bad = _has_word(R.POSITIVE_WORDS), _has_word(R.NEGATIVE_WORDS)
    # one case within the other: no word list is searched twice
    return F.expr(_case([(good, _case([(bad, "'mixed'")], "'positive'")), (bad, "'negative'")], "'neutral'"))


def _has_word(words) -> str:
    """The byte search is a cheap necessary condition for the word match."""
    some = " OR ".join(f"contains(_ascii, '{w.removesuffix('*')}')" for w in words)
    return f"(({some}) AND rlike(_ascii, r'{word_pattern(words)}'))"


def source_label(col="source") -> Column:
    expr = F
    for source, label in S.SOURCE_LABELS.items():
        expr = expr.when(F.col(col) == source, F.lit(label))
    return expr.otherwise(F.col(col))


def nice(col) -> Column:
    """FEATURE_REQUEST -> Feature request."""
    words = F.replace(F.lower(F.col(col) if isinstance(col, str) else col), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))


def word_pattern(words) -> str:
    """The word list as one regular expression (compare without case)."""
    body = "|".join(w.replace("*", "[a-z]*") for w in words)
    return f"(^|[^a-z])({body})([^a-z]|$)"
