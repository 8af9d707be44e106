"""URL filters: pattern rules indexed by their rarest literal token. DataFrame operations only.

A rule is a host and path (`example.net/en/`: the host and its subdomains, paths that begin so), or a pattern: literal
text in lower case, `^` for an end or any character but a-z and 0-9, `*` for anything. Tokens are runs of a-z and 0-9;
a rule's literal tokens are those with fixed borders, which every URL it fits must have. The index holds each rule
under the token that the fewest URLs have (a rule without one under the empty token, which all have). A URL's tokens
fetch candidates by an equi-join, and only these run their regular expressions, on each distinct host and path once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from echoloom.llm import shared

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class HostRule:
    text: str
    verdict: str

    @property
    def regex(self) -> str:
        return rf"^(?:[^/]*\.)?{re.escape(self.text)}"

    @property
    def tokens(self) -> list[str]:
        return _tokens(self.text if self.text.endswith("/") else self.text + "*", "^")


@dataclass(frozen=True)
class Pattern:
    text: str
    verdict: str = "block"

    @property
    def regex(self) -> str:
        plain = {"^": "(?:^|[^a-z0-9]|$)", "*": "(?s:.*)"}
        return "".join(plain.get(c) or re.escape(c) for c in self.text)

    @property
    def tokens(self) -> list[str]:
        return _tokens(self.text, "*")


def _tokens(text: str, begin: str) -> list[str]:
    """Runs of a-z and 0-9 with a literal or `^` on both sides; `begin` is what stands before the text."""
    whole = begin + text + "*"
    return sorted({m.group() for m in re.finditer("[a-z0-9]+", whole.translate(str.maketrans(UPPER, LOWER)))
                   if whole[m.start() - 1] != "*" and whole[m.end()] != "*"})


HOSTS = (HostRule("net/", "block"), HostRule("example.net/en/", "allow"), HostRule("example.com/de/", "block"),
         HostRule("org/fr/", "allow"))
PATTERNS = tuple(Pattern(p) for p in (
    "^casino-*", "^free-bets^", "^spam-farm^", "^ads-track^", "^cheap-pills^", "^adult-x^", "^xxx^", "^porn^", "^viagra^",
    "^warez^", "^torrent^", "^doubleclick.", "/ads/banner^", "^login/reset-password^", "^track^click^"))


def parts(url):
    """(host, path) of a URL column; A-Z of the host in lower case; both empty without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _split(text):
    return F.array_distinct(F.concat(F.split(text, "[^a-z0-9]+"), F.array(F.lit(""))))


def judge(pages: DataFrame, hosts=HOSTS, patterns=PATTERNS) -> DataFrame:
    """`pages` with host, path, rule, verdict and pattern, the names being replaced where `pages` has them.

    The longest host rule that fits decides; else a URL that a pattern fits is blocked (`pattern` names the first by
    code point) and any other is allowed. Null and empty URLs, and those without `://`, have empty hosts and paths,
    which patterns may still fit. Rows that repeat are judged alike; all rows and other columns stay.
    """
    spark = pages.sparkSession
    pages = pages.drop("host", "path", "rule", "verdict", "pattern")
    host, path = parts(F.col("url").cast("string"))
    pages = pages.withColumn("host", host).withColumn("path", path)
    keys = (pages.select("host", "path").distinct()
            .withColumn("key", F.concat("host", "path")).withColumn("low", F.translate("key", UPPER, LOWER)))
    rules = shared.literal_rows(spark, [
        {"id": i, "text": r.text, "verdict": r.verdict, "is_host": isinstance(r, HostRule), "regex": r.regex,
         "tokens": r.tokens or [""]} for i, r in enumerate([*hosts, *patterns])],
        "id:int,text:string,verdict:string,is_host:boolean,regex:string,tokens:array<string>")
    listed = rules.select("id", F.explode("tokens").alias("token"))
    counts = (keys.select(F.explode(_split(F.col("low"))).alias("token"))
              .join(listed.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n")))
    rarest = listed.join(counts, "token", "left").groupBy("id").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)), "token"))["token"].alias("token"))
    index = rules.join(rarest, "id").drop("tokens")
    fits = F.rlike(F.when(F.col("is_host"), F.col("key")).otherwise(F.col("low")), F.col("regex"))
    best = (keys.withColumn("token", F.explode(_split(F.col("low")))).join(index, "token").where(fits)
            .groupBy("host", "path").agg(
                F.max(F.when(F.col("is_host"), F.struct(F.char_length("text"), "text", "verdict"))).alias("rule"),
                F.min(F.when(~F.col("is_host"), F.struct("text", "verdict"))).alias("pattern")))
    best = best.select(F.col("host").alias("k_host"), F.col("path").alias("k_path"), F.col("rule.text").alias("rule"),
                       F.coalesce("rule.verdict", "pattern.verdict").alias("verdict"),
                       F.col("pattern.text").alias("pattern"))
    return (pages.join(best, (F.col("host") == F.col("k_host")) & (F.col("path") == F.col("k_path")), "left")
            .drop("k_host", "k_path").withColumn("verdict", F.coalesce("verdict", F.lit("allow"))))
