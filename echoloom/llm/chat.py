r"""Chat formatting in budgeted windows.

A turn costs its words and `OVERHEAD`. Prefix sums over a conversation's turns deal them into windows: a window's new
turns are those that end in one cell of half the free budget, so they fill the free budget at most; a turn longer than
a cell stands alone. The free budget is what the system turn and the history leave (a quarter of the budget at
least). Windows after the first repeat the system turn, and each repeats up to two turns before it while they fit
`HISTORY`. Only new assistant turns are under the loss mask.

A turn reads `### role`, line break, text, line break, `</turn>`, line break. In roles and texts `\` is written `\\`,
`<` `\l`, `#` `\h` and in roles a line break `\n`, so no text can hold a marker.

Conversations are cut at every `SEGMENT` turn numbers for sorting only, so one conversation of any length spreads over
tasks. Prefix sums go on across the cut, windows hold turns of both sides, and history reaches over it to the two turns
before, whatever their numbers: results are the same wherever the cuts are.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from echoloom.llm import shared

BUDGET, HISTORY, OVERHEAD, SEGMENT = 512, 96, 4, 4096
COUNT = r"size(filter(split({0}, '[\\x20\\x09-\\x0D]+'), x -> x <> ''))"
_BACK = {"\\\\": "\\", "\\l": "<", "\\h": "#", "\\n": "\n"}


def escaped(text, role: bool = False):
    for plain, written in (("\\", "\\\\"), ("<", "\\l"), ("#", "\\h")) + ((("\n", "\\n"),) if role else ()):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescaped(text: str) -> str:
    return re.sub(r"\\[\\lhn]", lambda m: _BACK[m.group()], text)


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, text, n_repeated, loss, n_tokens), in order of window per conversation.

    Turns are ordered by turn (null first), then role, then text; repeated rows are turns of their own. Null roles and
    texts count as empty; a null conv_id is a conversation. The system turn is a first turn of role `system`. `loss`
    holds (start, end) in code points of `text`; the first `n_repeated` turns of a window are repeats. Texts are never
    cut, whatever their length. Other columns are ignored; an empty table gives no rows.
    """
    turn = F.col("turn").cast("long")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.floor(turn / SEGMENT), F.lit(-(1 << 52))).alias("segment"))
    own = Window.partitionBy("conv_id", "segment")
    # texts are written once and looked up by (conv_id, segment, nth); windows are decided on numbers only
    turns = shared.saved(rows.withColumn("tokens", (F.expr(COUNT.format("text")) + OVERHEAD).cast("long"))
                         .withColumn("nth", F.row_number().over(own.orderBy("turn", "role", "text"))).drop("turn"), "chat-turns")
    slim = _placed(turns.select("conv_id", "segment", "nth", "tokens", (F.col("role") == "system").alias("is_system")), budget, history)
    t, s = turns.alias("t"), slim.select("conv_id", "window", F.explode("members").alias("m")).alias("s")
    same = (F.col("t.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("t.segment") == F.col("s.m.segment"))
            & (F.col("t.nth") == F.col("s.m.nth")))
    grouped = t.join(s, same).groupBy("s.conv_id", "s.window").agg(
        F.sort_array(F.collect_list(F.struct(F.col("s.m.part").alias("part"), "t.segment", "t.nth", "t.role", "t.text"))).alias("turns"),
        F.sum(F.when(F.col("s.m.part") == NEW, F.col("t.tokens"))).alias("n_tokens"))
    pieces = F.transform("turns", lambda x: F.struct(
        F.concat(F.lit("### "), escaped(x["role"], True), F.lit("\n")).alias("start"), escaped(x["text"]).alias("body"),
        ((x["part"] == NEW) & (x["role"] == "assistant")).alias("learn"), (x["part"] != NEW).alias("repeated")))
    grouped = grouped.select("conv_id", "window", pieces.alias("pieces"), "n_tokens")
    end = "\n</turn>\n"
    spans = F.aggregate("pieces", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("loss")),
                        lambda a, x: F.struct(
                            (a["at"] + F.char_length(x["start"]) + F.char_length(x["body"]) + len(end)).alias("at"),
                            F.when(x["learn"], F.concat(a["loss"], F.array(F.struct(
                                (a["at"] + F.char_length(x["start"])).alias("start"),
                                (a["at"] + F.char_length(x["start"]) + F.char_length(x["body"])).alias("end")))))
                            .otherwise(a["loss"]).alias("loss")), lambda a: a["loss"])
    return grouped.select("conv_id", "window",
                          F.concat_ws("", F.transform("pieces", lambda x: F.concat(x["start"], x["body"], F.lit(end)))).alias("text"),
                          F.size(F.filter("pieces", lambda x: x["repeated"])).alias("n_repeated"), spans.alias("loss"), "n_tokens")


HEAD, PAST, NEW = 0, 1, 2      # the parts of a window, in order


def _placed(slim: DataFrame, budget: int, history: int) -> DataFrame:
    """(conv_id, window, members): for every turn its window and, at a window's first turn, the turns that it repeats too."""
    heads = slim.groupBy("conv_id").agg(F.min(F.struct("segment", "nth", "is_system", "tokens")).alias("h")).select(
        F.col("conv_id").alias("h_id"), F.when(F.col("h.is_system"), F.col("h")).alias("head"))
    rows = slim.join(heads, F.col("conv_id").eqNullSafe(F.col("h_id"))).drop("h_id")
    rows = rows.withColumn("is_head", F.coalesce((F.col("head.segment") == F.col("segment")) & (F.col("head.nth") == F.col("nth")), F.lit(False)))
    rows = rows.withColumn("cost", F.when(F.col("is_head"), 0).otherwise(F.col("tokens")))
    sums = rows.groupBy("conv_id", "segment").agg(F.sum("cost").alias("cost")).select(
        F.col("conv_id").alias("s_id"), F.col("segment").alias("s_segment"),
        F.coalesce(F.sum("cost").over(Window.partitionBy("conv_id").orderBy("segment").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))
    free = F.greatest(F.lit(budget - history) - F.coalesce("head.tokens", F.lit(0)), F.lit(budget // 4))
    order = Window.partitionBy("conv_id", "segment").orderBy("nth")
    rows = (rows.join(sums, F.col("conv_id").eqNullSafe(F.col("s_id")) & (F.col("segment") == F.col("s_segment"))).drop("s_id", "s_segment")
            .withColumn("after", F.col("offset") + F.sum("cost").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("before", F.col("after") - F.col("cost")).withColumn("cell", F.floor(free / 2))
            .withColumn("window", 2 * F.floor(F.greatest(F.col("after") - 1, F.lit(0)) / F.col("cell"))
                        + F.when(F.col("cost") > F.col("cell"), 0).otherwise(1)))
    # the last two turns of a segment, by rank, go on to the next ones as history
    past = F.struct("segment", "nth", "before", "is_head", "window")
    back = F.row_number().over(Window.partitionBy("conv_id", "segment").orderBy(F.desc("nth")))
    tails = (rows.withColumn("back", back).where("back <= 2").groupBy("conv_id", "segment")
             .agg(F.sort_array(F.collect_list(past)).alias("tail")))
    cut = Window.partitionBy("conv_id").orderBy("segment")
    none = F.slice("tail", 1, 0)
    carried = F.concat(F.coalesce(F.lag("tail", 2).over(cut), none), F.coalesce(F.lag("tail", 1).over(cut), none))
    tails = tails.select(F.col("conv_id").alias("t_id"), F.col("segment").alias("t_segment"), carried.alias("carried")).where(F.size("carried") > 0)
    rows = rows.withColumn("p2", F.lag(past, 2).over(order)).withColumn("p1", F.lag(past, 1).over(order)).join(
        tails, F.col("conv_id").eqNullSafe(F.col("t_id")) & (F.col("segment") == F.col("t_segment")), "left")
    last = lambda i: F.try_element_at("carried", F.lit(-i))
    rows = (rows.withColumn("p2", F.when(F.col("nth") == 1, last(2)).when(F.col("nth") == 2, last(1)).otherwise(F.col("p2")))
            .withColumn("p1", F.when(F.col("nth") == 1, last(1)).otherwise(F.col("p1")))
            .withColumn("new", F.coalesce(F.col("p1.window") != F.col("window"), F.lit(True))))
    member = lambda part, x: F.struct(F.lit(part).alias("part"), x["segment"].alias("segment"), x["nth"].alias("nth"))
    fits = lambda p: F.when(F.col("new") & ~F.col(f"{p}.is_head") & (F.col("before") - F.col(f"{p}.before") <= history), member(PAST, F.col(p)))
    members = F.array(F.when(F.col("new") & ~F.col("is_head") & F.col("head").isNotNull(), member(HEAD, F.col("head"))), fits("p2"), fits("p1"),
                      F.struct(F.lit(NEW).alias("part"), "segment", "nth"))
    return rows.select("conv_id", "window", F.filter(members, lambda x: x.isNotNull()).alias("members"))


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    out = []
    for piece in text.split("</turn>\n")[:-1]:
        role, body = piece[len("### "):].split("\n", 1)
        out.append((unescaped(role), unescaped(body[:-1])))
    return out


def _digests(batches):
    """Windows arrive by conversation and order; one window is in memory, the hashes run on."""
    key, state = None, None

    def row():
        n, turns, chars, loss, written = state
        return key[0], n, turns.hexdigest(), chars, loss.hexdigest(), written

    for batch in batches:
        out = []
        for conv, text, repeated, loss in zip(*(c.to_pylist() for c in batch.columns)):
            if key != (conv,):
                if key:
                    out.append(row())
                key, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, body in parsed(text)[repeated:]:
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
            for span in loss:
                learnt = unescaped(text[span["start"]:span["end"]])
                state[2] += len(learnt)
                state[3].update(learnt.encode())
            state[4] += len(text)
        yield pa.RecordBatch.from_pylist([dict(zip(DIGEST, r)) for r in out], DIGEST_SCHEMA)
    if key:
        yield pa.RecordBatch.from_pylist([dict(zip(DIGEST, row()))], DIGEST_SCHEMA)


DIGEST = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
DIGEST_SCHEMA = pa.schema([(c, pa.string() if c.endswith("sha256") else pa.int64()) for c in DIGEST])


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, what its windows say: see `DIGEST`. A conversation's windows stream through one task in order."""
    shared.small_batches(formatted.sparkSession)
    rows = (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window")
            .select("conv_id", "text", "n_repeated", "loss"))
    kinds = ", ".join(f"{c} {'string' if c.endswith('sha256') else 'long'}" for c in DIGEST)
    return rows.mapInArrow(_digests, kinds)
