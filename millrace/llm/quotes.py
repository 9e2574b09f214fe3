"""Conversations without quotes, in reply order, by linking quoted passages.

Lines that begin with ``>`` marks are quotes; the number of marks is the level.
A passage is a run of lines of one level without an empty line between. Passages
are normalised (lower case, single spaces); a quoted passage links to the earliest
message of its conversation whose own words hold it, be it the whole message or
any whole words that follow each other there. Candidates share a hashed run of
words with the passage, and their text is compared with it. A passage without
letters or digits links to a whole message, paragraph or line. The message that
most outermost passages come from is the one replied to, the latest of several that
as many come from. Very long messages are searched whole. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored

MARKS = r"^[> \t]*"
NEW_LINE = r"\r\n|\r|\n"
# A line such as "On Monday X wrote:" right above a quote belongs to the quote.
INTRODUCTION = r"(?m)^[^\r\n>]*\bwrote:[ \t]*(\r\n|\r|\n)(?=[ \t]*>)"
QUOTE_LINES = r"(?m)^[ \t]*>[^\r\n]*(\r\n|\r|\n|\z)"

# Signs of scripts that put no space between words are words of their own.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
WORD = rf"[{UNSPACED}]|[\p{{L}}\p{{M}}\p{{N}}&&[^{UNSPACED}]]+"
# A passage is looked up by runs of the most words of these that it has.
RUNS = (8, 4, 2, 1)


def has_quotes(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"(?m)^[ \t]*>"), F.lit(False))


def without_quotes(text: str) -> Column:
    """The message's own words; texts without quotes stay as they are."""
    own = F.regexp_replace(F.regexp_replace(text, INTRODUCTION, ""), QUOTE_LINES, "")
    return F.when(has_quotes(text), F.btrim(own, F.lit(" \t\r\n"))).otherwise(F.col(text))


def level(line: Column) -> Column:
    """Number of ``>`` marks that begin the line."""
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(F.regexp_replace(marks, "[^>]", ""))


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def quoted_passages(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, outer, passage): the quotes of the messages that have any.

    ``outer`` marks the passages of a message's lowest quote level. Lines are
    cut and gathered within one message each.
    """
    lines = messages.select(
        "conv_id",
        "turn",
        F.xxhash64("role", "text").alias("message"),
        F.posexplode(F.split("text", NEW_LINE)).alias("place", "line"),
    )
    marked = lines.withColumn("level", level(F.col("line"))).withColumn(
        "content", F.trim(F.regexp_replace("line", MARKS, ""))
    )
    message = ["conv_id", "turn", "message"]
    in_order = Window.partitionBy(*message).orderBy("place")
    before = F.lag(F.struct("level", (F.col("content") == "").alias("empty"))).over(in_order)
    new = before.isNull() | (before["level"] != F.col("level")) | before["empty"]
    numbered = marked.withColumn("new", new.cast("int")).withColumn(
        "number", F.sum("new").over(in_order)
    )
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "content"))), lambda x: x["content"]),
        " ",
    )
    lowest = F.min("level").over(Window.partitionBy(*message))
    return (
        numbered.filter((F.col("level") > 0) & (F.col("content") != ""))
        .groupBy(*message, "level", "number")
        .agg(normalised(joined).alias("passage"))
        .withColumn("outer", F.col("level") == lowest)
        .select("conv_id", "turn", "level", "outer", "passage")
    )


def words(text: str) -> Column:
    return F.regexp_extract_all(normalised(F.col(text)), F.lit(WORD), 0)


def marked(text: str) -> Column:
    """The normalised text with a mark on both sides of each word.

    A marked text that holds another one holds its words as whole words.
    """
    return F.regexp_replace(normalised(F.col(text)), f"({WORD})", "\x01$1\x01")


def runs(words: str, lengths: Column) -> Column:
    """Hashes of the different runs of so many words."""
    none = F.array().cast("array<bigint>")

    def of_length(length: Column) -> Column:
        last = F.greatest(F.size(words) - length, F.lit(0))
        hashed = F.transform(
            F.sequence(F.lit(0), last), lambda at: F.xxhash64(length, F.slice(words, at + 1, length))
        )
        return F.when(F.size(words) >= length, hashed).otherwise(none)

    return F.array_distinct(F.flatten(F.transform(lengths, of_length)))


def first_holders(own: DataFrame, wanted: DataFrame) -> DataFrame:
    """(conv_id, digest, first): the earliest messages whose own words hold the passages.

    A passage is compared with the messages that have its rarest run of words in
    the conversation, so runs that many messages share are met only by passages
    that have no others. Equal passages and equal messages of a conversation are
    compared once.
    """
    passages = wanted.filter(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())
    passages = passages.groupBy("conv_id", "digest", "passage").agg(F.max("turn").alias("until"))
    passages = passages.withColumn("words", words("passage")).filter(F.size("words") > 0)
    length = F.coalesce(*[F.when(F.size("words") >= r, F.lit(r)) for r in RUNS])
    passages = stored(passages.withColumn("length", length), "distinct-passages")
    asked = passages.groupBy("conv_id").agg(
        F.collect_set("length").alias("lengths"), F.max("until").alias("until")
    )
    texts = (
        own.join(asked, "conv_id")
        .filter(F.col("turn") < F.col("until"))
        .groupBy("conv_id", "own")
        .agg(F.min("turn").alias("turn"), F.any_value("lengths").alias("lengths"))
        .withColumn("message", F.xxhash64("own"))
    )
    texts = stored(texts, "asked-messages")
    ours = passages.select(
        "conv_id", "digest", F.explode(runs("words", F.array("length"))).alias("run")
    )
    ours = stored(ours, "passage-runs")
    theirs = texts.select("conv_id", "message", words("own").alias("words"), "lengths").select(
        "conv_id", "message", F.explode(runs("words", F.col("lengths"))).alias("run")
    )
    shared = theirs.join(ours.select("conv_id", "run").distinct(), ["conv_id", "run"], "left_semi")
    shared = stored(shared, "shared-runs")
    holders = shared.groupBy("conv_id", "run").agg(F.count("*").alias("holders"))
    rarest = F.min(F.struct(F.coalesce("holders", F.lit(0)).alias("holders"), "run"))
    looked_up = (
        ours.join(holders, ["conv_id", "run"], "left")
        .groupBy("conv_id", "digest")
        .agg(rarest.alias("rarest"))
        .filter(F.col("rarest.holders") > 0)
        .select("conv_id", "digest", F.col("rarest.run").alias("run"))
    )
    candidates = (
        looked_up.join(shared, ["conv_id", "run"])
        .select("conv_id", "digest", "message")
        .join(passages.select("conv_id", "digest", marked("passage").alias("passage")), ["conv_id", "digest"])
        .join(texts.select("conv_id", "message", "turn", marked("own").alias("own")), ["conv_id", "message"])
    )
    return (
        candidates.filter(F.contains("own", "passage"))
        .groupBy("conv_id", "digest")
        .agg(F.min("turn").alias("first"))
    )


def first_units(own: DataFrame, wanted: DataFrame) -> DataFrame:
    """The same for passages without words: messages, paragraphs and lines equal to them."""
    asked = wanted.filter(F.size(words("passage")) == 0).select("conv_id").distinct()
    texts = own.join(asked, "conv_id", "left_semi")
    paragraphs = F.split("own", rf"({NEW_LINE})[ \t]*({NEW_LINE})[\r\n]*")
    lines = F.split("own", NEW_LINE)
    return (
        texts.select(
            "conv_id",
            "turn",
            F.explode(F.concat(F.array("own"), paragraphs, lines)).alias("passage"),
        )
        .filter(F.size(words("passage")) == 0)
        .select("conv_id", "turn", F.xxhash64(normalised(F.col("passage"))).alias("digest"))
        .groupBy("conv_id", "digest")
        .agg(F.min("turn").alias("first"))
    )


def linked(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, reply_to, thread, depth, quotes, linked of every message.

    ``text`` is the message without quotes; ``reply_to`` the turn answered, null
    where no quote links; ``thread`` the turn that the chain of replies begins
    with and ``depth`` the message's place in the chain, so that conv_id,
    thread, depth, turn is a reply order. ``quotes`` and ``linked`` count the
    quoted passages and those found. A quote of what nobody wrote earlier in the
    conversation links nowhere. Messages that repeat conv_id and turn all come
    back; those with quotes share their link. A null text stays null; null
    conversations or turns link nothing. An empty table gives no rows.

    Messages without quotes, mostly nearly all, are neither shuffled nor joined.
    """
    kept = messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    quoting = kept.filter(has_quotes("text"))
    passages = stored(
        quoted_passages(quoting).withColumn("digest", F.xxhash64("passage")), "quoted-passages"
    )
    own = kept.select("conv_id", "turn", without_quotes("text").alias("own"))
    first = first_holders(own, passages).unionByName(first_units(own, passages))
    found = passages.join(first, ["conv_id", "digest"], "left").withColumn(
        "first", F.when(F.col("first") < F.col("turn"), F.col("first"))
    )
    votes = (
        found.groupBy("conv_id", "turn", "first")
        .agg(F.count_if("outer").alias("outer"), F.count("*").alias("all"))
        .groupBy("conv_id", "turn")
        .agg(
            F.max(
                F.when(
                    F.col("first").isNotNull() & (F.col("outer") > 0), F.struct("outer", "first")
                )
            )["first"].alias("reply_to"),
            F.sum("all").alias("quotes"),
            F.sum(F.when(F.col("first").isNotNull(), F.col("all")).otherwise(0)).alias("linked"),
        )
    )
    replies = stored(votes, "quote-links")
    chains = _chains(replies.filter(F.col("reply_to").isNotNull()).select("conv_id", "turn", "reply_to"))
    answers = replies.join(chains, ["conv_id", "turn"], "left").select(
        F.col("conv_id").alias("of_conv"),
        F.col("turn").alias("of_turn"),
        "reply_to",
        "quotes",
        "linked",
        "thread",
        "depth",
    )
    same = (F.col("conv_id") == F.col("of_conv")) & (F.col("turn") == F.col("of_turn"))
    message = ["conv_id", "turn", "role", without_quotes("text").alias("text")]
    none = F.lit(0).cast("bigint")
    answered = quoting.join(answers, same, "left").select(
        *message,
        "reply_to",
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).alias("depth"),
        F.coalesce("quotes", none).alias("quotes"),
        F.coalesce("linked", none).alias("linked"),
    )
    plain = kept.filter(~has_quotes("text")).select(
        *message,
        F.lit(None).cast("bigint").alias("reply_to"),
        F.col("turn").alias("thread"),
        F.lit(0).alias("depth"),
        none.alias("quotes"),
        none.alias("linked"),
    )
    return plain.unionByName(answered)


def _chains(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth): replies followed to the first message.

    Each round doubles how far a pointer reaches; replies point to earlier turns,
    so the rounds end after the logarithm of the longest chain.
    """
    at = stored(
        replies.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).alias("depth")),
        "reply-chains",
    )
    while True:
        further = at.select(
            "conv_id",
            F.col("turn").alias("thread"),
            F.col("thread").alias("next"),
            F.col("depth").alias("more"),
        )
        moved = at.join(further, ["conv_id", "thread"], "left")
        if moved.filter(F.col("next").isNotNull()).isEmpty():
            return at
        at = stored(
            moved.select(
                "conv_id",
                "turn",
                F.coalesce("next", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            ),
            "reply-chains",
        )
