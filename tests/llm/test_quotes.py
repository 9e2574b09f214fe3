"""Quotation linking on written conversations."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from millrace.llm import quotes
from millrace.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, digest int"


def linked(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return {(r.conv_id, r.turn): r for r in quotes.linked(frame).collect()}


def test_nested_quotes(spark):
    found = linked(
        spark,
        [
            (1, 0, "a", "Hello there,\nhow ARE you?\n\nSecond paragraph."),
            (1, 1, "b", "On Monday a wrote:\n> Hello   there,\n> how are you?\n\nFine, thanks."),
            (1, 2, "a", ">> hello there,\r\n>> how are you?\r\n> Fine, thanks.\r\nGood."),
            (1, 3, "c", "> > second paragraph.\nTo the first one."),
            (1, 4, "c", "> nobody wrote this\nRight."),
            (2, 5, "d", "> Good.\nAnother conversation."),
        ],
    )
    shape = {k: (r.reply_to, r.thread, r.depth, r.quotes, r.linked) for k, r in found.items()}
    assert shape == {
        (1, 0): (None, 0, 0, 0, 0),
        (1, 1): (0, 0, 1, 1, 1),
        (1, 2): (1, 0, 2, 2, 2),
        (1, 3): (0, 0, 1, 1, 1),
        (1, 4): (None, 4, 0, 1, 0),
        (2, 5): (None, 5, 0, 1, 0),
    }
    assert found[1, 1].text == "Fine, thanks."
    assert found[1, 2].text == "Good."
    assert found[1, 0].text == "Hello there,\nhow ARE you?\n\nSecond paragraph."


def test_only_earlier_messages_are_quoted_and_the_first_counts(spark):
    found = linked(
        spark,
        [
            (1, 0, "a", "> later words\nfirst"),
            (1, 1, "a", "later words"),
            (1, 2, "a", "later words"),
            (1, 3, "a", "> later words\nyes"),
        ],
    )
    assert found[1, 0].reply_to is None
    assert found[1, 3].reply_to == 1


def test_a_long_chain(spark):
    rows = [(1, 0, "a", "word0")]
    rows += [(1, i, "a", f"> word{i - 1}\nword{i}") for i in range(1, 70)]
    found = linked(spark, rows)
    assert all(found[1, i].depth == i and found[1, i].thread == 0 for i in range(70))


def test_many_messages_quote_one(spark):
    rows = [(1, 0, "a", "the same words")] + [(1, i, "b", "> The same\n> words\n+1") for i in range(1, 300)]
    found = linked(spark, rows)
    assert Counter(r.reply_to for r in found.values()) == {None: 1, 0: 299}


def test_trimmed_quotes(spark):
    found = linked(
        spark,
        [
            (1, 0, "a", "The plan is late.\nWe need two more weeks.\nCan you help?\n\nThanks\n\nThe end"),
            (1, 1, "b", "> We need two more weeks.\n> Can you help?\nNo."),
            (1, 2, "b", "> can you help?\n> Thanks\n> The end\nPerhaps."),
            (1, 3, "c", "> weeks\nSo long. It is a very long line, really, with a sentence in it. Well."),
            (1, 4, "d", "> it is a very long line, really, with a sentence in it\nYes."),
            (1, 5, "d", "> elp?\nA part of a word."),
            (1, 6, "d", "> We need three more weeks.\nOther words."),
            (1, 7, "d", "> two more, weeks\nOther signs."),
            (1, 8, "e", "会议在星期五举行。"),
            (1, 9, "e", "> 星期五\n好"),
            (1, 10, "e", "-----\nx"),
            (1, 11, "e", "> ---\nNo such line."),
            (1, 12, "e", "> -----\nThis line."),
            (1, 13, "e", "> other signs. other signs.\nNot across messages."),
        ],
    )
    replies = {turn: r.reply_to for (_, turn), r in found.items()}
    assert replies == dict.fromkeys(range(14)) | {1: 0, 2: 0, 3: 0, 4: 3, 9: 8, 12: 10}


def test_passages_that_share_most_words(spark):
    same = "all of these many words are found in each of the messages of this talk"
    rows = [(1, i, "a", f"{same} number{i} {same}") for i in range(200)]
    rows += [(1, 200 + i, "b", f"> messages of this talk number{i} all of\nyes") for i in range(200)]
    rows += [(1, 400, "c", f"> {same}\nwell")]
    found = linked(spark, rows)
    assert all(found[1, 200 + i].reply_to == i for i in range(200))
    assert found[1, 400].reply_to == 0


def test_odd_rows(spark):
    rows = [
        (1, 0, "a", None),
        (1, 1, "a", ""),
        (None, 2, "a", "> x"),
        (1, None, "a", "> x"),
        (1, 3, None, ">"),
        (1, 3, None, ">"),
        (1, 4, "a", ">" * 3000 + " deep"),
        (1, 5, "a", "word " * 100_000),
        (1, 6, "a", "> " + "word " * 100_000),
        (1, 7, "a", "a > b\nc"),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    found = quotes.linked(frame).collect()
    assert Counter((r.conv_id, r.turn, r.role) for r in found) == Counter(r[:3] for r in rows)
    texts = {r.turn: r.text for r in found if r.conv_id == 1}
    assert texts[0] is None and texts[1] == "" and texts[3] == "" and texts[7] == "a > b\nc"
    assert {r.turn: r.reply_to for r in found if r.conv_id == 1}[6] == 5
    assert quotes.linked(frame.limit(0)).count() == 0


def test_query_returns_every_message(spark, capsys):
    messages = spark.read.parquet(f"{SMALL}/conversations.parquet")
    found = QUERIES["op3_quotes"][0](spark, SMALL)
    columns = ["conv_id", "turn", "role", "text"]
    rows = messages.select(*columns).filter("text not rlike '(?m)^[ \\t]*>'").collect()
    assert Counter(map(tuple, found.filter("quotes = 0").select(*columns).collect())) >= Counter(
        map(tuple, rows)
    )
    assert found.count() == messages.count()
    found.explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def plain_own(text):
    lines = re.split("\r\n|\r|\n", text)
    quote = [bool(re.match(r"[ \t]*>", line)) for line in lines]
    if not any(quote):
        return text
    kept = [
        line
        for i, line in enumerate(lines)
        if not quote[i]
        and not (re.search(r"\bwrote:[ \t]*$", line) and i + 1 < len(lines) and quote[i + 1])
    ]
    return "\n".join(kept).strip(" \t\r\n")


def plain_passages(text):
    """(level, words) of the quoted passages."""
    found, before = [], (None, True)
    for line in re.split("\r\n|\r|\n", text):
        marks = re.match("[> \t]*", line).group()
        level, content = marks.count(">"), line[len(marks) :].strip(" ")
        if level and content:
            if before != (level, False):
                found.append([level, ""])
            found[-1][1] += " " + content
        before = level, not content
    return found


def in_words(text):
    return re.sub("([a-z0-9]+)", "\x01\\1\x01", re.sub(r"\s+", " ", text.lower()).strip(" "))


def plain(rows):
    """(conv_id, turn) to (text, reply_to, thread, depth, quotes, linked), message by message."""
    own = {(conv, turn): plain_own(text) for conv, turn, _, text in rows}
    shape = {}
    for conv, turn, _, text in sorted(rows):
        passages = plain_passages(text)
        votes, linked = Counter(), 0
        for level, passage in passages:
            holders = [
                t for c, t in own if c == conv and t < turn and in_words(passage) in in_words(own[c, t])
            ]
            if holders:
                linked += 1
                votes[min(holders)] += level == min(level for level, _ in passages)
        voted = [(n, t) for t, n in votes.items() if n]
        reply = max(voted)[1] if voted else None
        above = shape.get((conv, reply))
        thread, depth = (above[2], above[3] + 1) if above else (turn, 0)
        shape[conv, turn] = own[conv, turn], reply, thread, depth, len(passages), linked
    return shape


def conversation(draw, conv):
    """Messages that quote earlier ones whole, in part, nested, restyled or wrongly."""
    vocabulary = [f"w{i}" for i in range(draw.choice([4, 30, 300]))]
    texts = []
    for turn in range(draw.randint(2, 14)):
        parts = []
        for _ in range(draw.choice([0, 0, 1, 1, 2, 3]) if texts else 0):
            lines = draw.choice(texts).split("\n")
            first = draw.randrange(len(lines))
            quoted = lines[first : first + draw.randint(1, 4)] if draw.random() < 0.6 else lines
            if draw.random() < 0.4:
                words = " ".join(quoted).split()
                cut = draw.randrange(len(words)) if words else 0
                quoted = [" ".join(words[cut : cut + draw.randint(1, 9)])]
            if draw.random() < 0.2:
                quoted = [line.upper().replace(" ", "   ") for line in quoted]
            if draw.random() < 0.1:
                quoted = [line + " never" for line in quoted]
            if draw.random() < 0.3:
                parts.append("On Monday somebody wrote:")
            mark = draw.choice(["> ", ">", ">> ", "> > "])
            parts += [mark + line for line in quoted]
            if draw.random() < 0.5:
                parts.append("")
        for _ in range(draw.randint(0 if parts else 1, 4)):
            line = " ".join(draw.choices(vocabulary, k=draw.randint(1, 7)))
            parts.append(line + draw.choice(["", ".", ",", "\n"]))
        texts.append("\n".join(parts))
    return [(conv, turn, draw.choice("ab"), text) for turn, text in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations_against_every_pair_of_messages(spark, seed):
    draw = random.Random(seed)
    rows = [row for conv in range(60) for row in conversation(draw, conv)]
    found = {
        key: (r.text, r.reply_to, r.thread, r.depth, r.quotes, r.linked)
        for key, r in linked(spark, rows).items()
    }
    wanted = plain(rows)
    assert sum(shape[5] for shape in wanted.values()) > 100
    assert found == wanted


def test_of_messages_quoted_equally_often_the_latest_is_answered(spark):
    rows = [(1, 0, "a", "one thing"), (1, 1, "b", "other thing"), (1, 2, "c", "> other thing\n\n> one thing\nboth")]
    assert linked(spark, rows)[1, 2].reply_to == 1
    rows[2] = (1, 2, "c", "> one thing\n\n> other thing\n\n> one thing\nboth")
    assert linked(spark, rows)[1, 2].reply_to == 0
