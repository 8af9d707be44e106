import itertools
import random
import re

from pyspark.sql import functions as F

from echoloom.functions import rules as R
from echoloom.functions.text import ascii_lower, has_contact, mask, mask_expr, web_trim


def plain_mask(text):
    text = re.sub(R.EMAIL, R.EMAIL_TOKEN, text, flags=re.A)
    text = re.sub(R.UK_PHONE, R.PHONE_TOKEN, text, flags=re.A)
    return re.sub(R.INTL_PHONE, R.PHONE_TOKEN, text, flags=re.A)


def masked(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.m for r in df.select("i", mask_expr("t").alias("m")).orderBy("i").collect()]


def test_mask_contacts_and_keep_issue_numbers(spark):
    assert masked(spark, ["Call 07700 900190 or person@example.com",
                          "07700-900190 and +1-234-567-8900",
                          "Found Pho 24. CHK-500 on 4.2.1"]) == [
        "Call [PHONE] or [EMAIL]", "[PHONE] and [PHONE]", "Found Pho 24. CHK-500 on 4.2.1"]


def test_mask_equals_the_three_plain_passes(spark):
    rng = random.Random(7)
    pieces = ["a@b.com", "x_y@c.org", "a@b.comx_y@c.org", "@", "..", "07700 900190", "+1-234-567-8900",
              "0123456789", "(020) 123 4567", " ", "-", "%", "tel:", "a.b+c@d-e.co.uk", "1 07700900190",
              "word", "@x.yz", "[EMAIL]", "99", "\n"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 9))) for _ in range(400)]
    assert masked(spark, texts) == [plain_mask(t) for t in texts]


def test_mask_is_linear_on_long_tokens(spark):
    text = "a" * 200_000 + " mail me@x.org"
    assert masked(spark, [text]) == ["a" * 200_000 + " mail [EMAIL]"]


def test_masked_rows_hold_no_contact(spark):
    df = spark.createDataFrame([("mail a@b.co", "0770 000", None), ("+44 020 123 4567", "u", "x@y.io")],
                               "message_text string, user_id string, metadata string")
    assert df.where(has_contact()).count() == 2
    assert mask(df).where(has_contact()).count() == 0


def test_lower_case_and_trim(spark):
    row = spark.range(1).select(ascii_lower(F.lit("AKÉİz")).alias("a"), ascii_lower(F.lit("AbÉ")).alias("b"),
                                web_trim(F.lit(" \t x ﻿")).alias("c")).first()
    assert row.a == "aKÉİz" and row.b.startswith("ab") and row.c == "x"


def test_guards_pass_every_number(spark):
    """Whatever the patterns of phone numbers find passes their guard; texts without ten digits close together do not."""
    gaps = ["", " ", "-", ".", ") ", " - ", "\t", "x", "[EMAIL]"]
    texts = [f"Order 7 {a}07700{b}900{c}1905{d}" for a, b, c, d in itertools.product(["", "+1-", "(", "a@b.com"], gaps, gaps, ["", "6", " 12", "x@y.org 33"])]
    texts += ["Order 123456789.", "4 5 6 7 8 9 0 1 2 3", "", "1" * 40, "12345 a@b.com 678901", None]
    plain = lambda t: re.sub(R.INTL_PHONE, R.PHONE_TOKEN, re.sub(R.UK_PHONE, R.PHONE_TOKEN, re.sub(R.EMAIL, R.EMAIL_TOKEN, t)))
    rows = spark.createDataFrame([(t, None, None) for t in texts], "message_text string, user_id string, metadata string")
    rows = rows.withColumn("raw", F.col("message_text"))
    got = mask(rows).select("raw", "message_text", has_contact(["raw"]).alias("found"), F.col("raw").rlike(R.TEN_DIGITS).alias("guard")).collect()
    for r in got:
        if r.raw is not None:
            assert r.message_text == plain(r.raw), r.raw
            assert r.found == bool(re.search(f"{R.EMAIL}|{R.UK_PHONE}|{R.INTL_PHONE}", r.raw)), r.raw
    assert not next(r.guard for r in got if r.raw == "Order 123456789.")
