"""Contact masking and text matching, as Catalyst expressions."""

import string

from pyspark.sql import Column, DataFrame, functions as F

from echoloom.functions import rules as R


def mask_expr(col) -> Column:
    """Replace e-mail addresses and phone numbers.

    The three passes run in order over the whole text. The guards are cheap necessary
    conditions (an e-mail needs an "@", a phone number ten digits close together), so most
    messages skip the regex passes. A token has letters, so none of them makes a number of what it replaces.
    """
    col = F.col(col) if isinstance(col, str) else col
    no_mail = F.when(col.contains("@"), F.regexp_replace(col, R.EMAIL_LINEAR, R.EMAIL_TOKEN)).otherwise(col)
    no_uk = F.regexp_replace(no_mail, R.UK_PHONE, R.PHONE_TOKEN)
    no_phone = F.regexp_replace(no_uk, R.INTL_PHONE, R.PHONE_TOKEN)
    return F.when(col.rlike(R.TEN_DIGITS), no_phone).otherwise(no_mail)


def mask(df: DataFrame, cols=None) -> DataFrame:
    return df.withColumns({c: mask_expr(c) for c in cols or R.CONTACT_COLUMNS})


def has_contact(cols=None) -> Column:
    """True when a contact pattern is present in any of the columns (NULL counts as absent)."""
    found = F.lit(False)
    for c in cols or R.CONTACT_COLUMNS:
        col = F.col(c)
        hit = ((col.contains("@") & col.rlike(R.EMAIL_LINEAR)) |
               (col.rlike(R.TEN_DIGITS) & col.rlike(f"{R.UK_PHONE}|{R.INTL_PHONE}")))
        found = found | F.coalesce(hit, F.lit(False))
    return found


def ascii_lower(col) -> Column:
    """Lower case for A-Z only, as case-insensitive patterns compare.

    `lower` is the fast way and differs in what matters here only for the two characters
    whose lower case holds an ASCII letter (Kelvin sign, dotted capital I).
    """
    odd = col.contains("\u212a") | col.contains("\u0130")
    slow = F.translate(col, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(odd, slow).otherwise(F.lower(col))


def web_trim(col) -> Column:
    return F.btrim(F.col(col) if isinstance(col, str) else col, F.lit(R.WEB_BLANKS))


def search_match(q: str) -> Column:
    """Case-insensitive literal search of the whole query over message, explanation and ID."""
    needle = q.lower()
    hay = F.concat_ws(" ", "message_text", F.coalesce("explanation", F.lit("")), "feedback_id")
    return F.lower(hay).contains(needle)
