"""Conversations in reply order, linked through the passages that messages quote.

A line's quote level is the number of ``>`` marks before it.  The normalised lines of a
message's own text (level 0) are hashed; a quoted line is joined to the first message of
the same conversation that says it, or else to the first message of any conversation.
The message that most quoted lines of the least level lead to is the one replied to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.llm.common import store

#: Leading quote marks, with the spaces between them.
_MARKS = r"^(?:[ \t]*>)+[ \t]?"


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"\s+", " ")))


def quote_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, line, level, body, key): the lines of every message; blank lines have no key."""
    lines = messages.select("conv_id", "turn", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\r?\n")).alias("line", "raw"))
    marks = F.regexp_extract("raw", _MARKS, 0)
    body = F.expr("substring(raw, length(_marks) + 1)")
    lines = lines.withColumn("_marks", marks).withColumn("body", body)
    lines = lines.withColumn("level", F.length(F.regexp_replace("_marks", "[^>]", "")))
    normal = _normal(F.col("body"))
    return lines.select("conv_id", "turn", "line", "level", "body", F.when(normal != "", F.xxhash64(normal)).alias("key"))




def reply_links(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, to_conv, to_turn, n_lines): the earlier message that each message replies to.

    Sayings are reduced to one message per conversation, and one per corpus, before
    they are joined: a line that everybody quotes costs one row per quote.
    """
    keyed = lines.where("key is not null and conv_id is not null and turn is not null")
    said = keyed.where("level = 0")
    here = said.groupBy("conv_id", "key").agg(F.min("turn").alias("here_turn"))
    # Within the corpus: the smallest conversation with the line, and its first turn there.
    first = here.groupBy("key").agg(F.min("conv_id").alias("any_conv"))
    anywhere = first.join(
        here.withColumnsRenamed({"conv_id": "any_conv", "here_turn": "any_turn"}), ["key", "any_conv"]
    )
    quoted = keyed.where("level > 0").groupBy("conv_id", "turn", "key").agg(F.min("level").alias("level"))
    found = quoted.join(here, ["conv_id", "key"], "left").join(anywhere, "key", "left")
    same = F.col("here_turn") < F.col("turn")
    earlier = F.expr("any_conv < conv_id or (any_conv = conv_id and any_turn < turn)")
    found = found.select(
        "conv_id", "turn", "level",
        F.when(same, F.col("conv_id")).when(earlier, F.col("any_conv")).alias("to_conv"),
        F.when(same, F.col("here_turn")).when(earlier, F.col("any_turn")).alias("to_turn"),
    ).where("to_conv is not null")
    # The least level quotes the message replied to; deeper ones what that message quoted.
    votes = found.groupBy("conv_id", "turn", "to_conv", "to_turn").agg(F.min("level").alias("level"), F.count(F.lit(1)).alias("n"))
    best = F.struct(-F.col("level"), F.col("n"), F.col("to_conv"), F.col("to_turn"))
    return votes.groupBy("conv_id", "turn").agg(F.max(best).alias("b"), F.sum("n").alias("n_linked")).select(
        "conv_id", "turn", F.col("b.to_conv").alias("to_conv"), F.col("b.to_turn").alias("to_turn"), "n_linked"
    )


def threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root_conv, root_turn, depth) of linked messages, by doubling of reply chains.

    Links lead to earlier messages, so chains end; each round doubles the steps taken.
    """
    held = store(links.select("conv_id", "turn", F.col("to_conv").alias("root_conv"), F.col("to_turn").alias("root_turn"), F.lit(1).alias("depth")), "threads")
    while True:
        up = held.select(
            F.col("conv_id").alias("root_conv"), F.col("turn").alias("root_turn"),
            F.col("root_conv").alias("next_conv"), F.col("root_turn").alias("next_turn"), F.col("depth").alias("more"),
        )
        moved = store(held.join(up, ["root_conv", "root_turn"], "left"), "threads")
        held = moved.select(
            "conv_id", "turn", F.coalesce("next_conv", "root_conv").alias("root_conv"),
            F.coalesce("next_turn", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )
        if moved.where("next_conv is not null").isEmpty():
            return held


def unquoted_text(raw: Column) -> Column:
    """A message without its quoted lines; other lines keep their text."""
    lines = F.split(F.coalesce(raw, F.lit("")), "\r?\n")
    kept = F.filter(lines, lambda line: ~line.rlike(_MARKS))
    return F.trim(F.array_join(kept, "\n"))


def conversations(messages: DataFrame) -> DataFrame:
    """Every message with its reply link, thread and text without quotes.

    ``root_conv`` and ``root_turn`` name the thread's first message (the message itself
    if it replies to none) and ``depth`` the replies in between: sorted by (root_conv,
    root_turn, conv_id, turn), a thread reads in reply order, since replies come after what
    they quote.  Null texts have no lines; messages with a null ``conv_id`` or ``turn`` are
    threads by themselves; repeated (conv_id, turn) rows share their link; an empty table
    gives no rows; other columns are ignored.
    """
    messages = messages.select("conv_id", "turn", "role", F.col("text").cast("string"))
    # Only messages that quote, and lines, pass through the joins.
    lines = store(quote_lines(messages).select("conv_id", "turn", "level", "key"), "lines")
    links = store(reply_links(lines), "links")
    found = links.join(threads(links), ["conv_id", "turn"])
    joined = messages.alias("m").join(
        found.alias("f"), F.expr("m.conv_id = f.conv_id and m.turn = f.turn"), "left"
    )
    n_quoted = F.size(F.filter(F.split(F.coalesce("m.text", F.lit("")), "\r?\n"), lambda line: line.rlike(_MARKS)))
    return joined.select(
        "m.conv_id", "m.turn", "m.role", "f.to_conv", "f.to_turn",
        F.coalesce("f.root_conv", "m.conv_id").alias("root_conv"), F.coalesce("f.root_turn", "m.turn").alias("root_turn"),
        F.coalesce("f.depth", F.lit(0)).alias("depth"), n_quoted.alias("n_quoted"),
        F.coalesce("f.n_linked", F.lit(0)).alias("n_linked"), unquoted_text(F.col("m.text")).alias("text"),
    )
