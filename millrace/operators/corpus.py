"""Line, word and character counts of a text column.

Counts per text are taken from array sizes, without a row per word; a row per
word exists only where words are the grouping key, and Spark then adds them up
within each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import (
    body_words,
    lines,
    non_space_chars,
    text_body,
    tight_body,
    without_loose_spaces,
)


def text_sizes(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """Texts, lines, words and non-space characters per group."""
    sizes = F.size(lines(F.col(text))).alias("lines"), non_space_chars(F.col(text)).alias("chars")
    counted = _worded(df.select(*by, text, *sizes), text, [*by, "lines", "chars"])
    return counted.groupBy(*by).agg(
        F.count("*").alias("texts"),
        F.sum("lines").alias("lines"),
        F.sum(_array_size("words")).alias("words"),
        F.sum("chars").alias("chars"),
    )


def line_count(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(F.size(lines(F.col(text)))).alias("lines"))


def char_count(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum(non_space_chars(F.col(text))).alias("chars"))


def token_hits(df: DataFrame, text: str, token: str, by: list[str]) -> DataFrame:
    """How often exactly this word occurs, case and punctuation included."""
    found = _worded(df, text, by)
    hits = _array_size("words") - _array_size(F.array_remove("words", token))
    return found.groupBy(*by).agg(F.sum(hits).alias("hits"))


def _bodies(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """The first step of cutting texts into rows, as a column of its own.

    In one expression the steps would be repeated inside each other, and the
    generated loop over the rows would be too long for the JVM to compile.
    """
    return df.select(*keep, text_body(F.col(text)).alias("body"))


def _tight(bodies: DataFrame, keep: list[str]) -> DataFrame:
    """The bodies without loose spaces, the costly step as a column of its own."""
    closed = bodies.select(*keep, "body", without_loose_spaces(F.col("body")).alias("closed"))
    return closed.select(*keep, tight_body(F.col("body"), F.col("closed")).alias("body"))


def _worded(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per text with its words; null if it has none."""
    bodies = _tight(_bodies(df, text, keep), keep)
    return bodies.select(*keep, body_words(F.col("body")).alias("words"))


def _array_size(values) -> F.Column:
    return F.coalesce(F.array_size(values), F.lit(0))


def text_lines(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per line with its position (from 0) in its text."""
    cut = F.posexplode(F.split("body", "\n")).alias("line_no", "line")
    return _bodies(df, text, keep).select(*keep, cut)


def lines_of(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """One row per line."""
    return _bodies(df, text, keep).select(*keep, F.explode(F.split("body", "\n")).alias("line"))


def words_of(df: DataFrame, text: str, drop_empty: bool = False) -> DataFrame:
    """One row per word."""
    bodies = _bodies(df, text, [])
    if not drop_empty:
        bodies = _tight(bodies, [])
    words = bodies.select(F.explode(body_words(F.col("body"))).alias("word"))
    return words.filter(F.col("word") != "") if drop_empty else words


def word_count(df: DataFrame, text: str, drop_empty: bool = False) -> DataFrame:
    """Occurrences of each word."""
    return words_of(df, text, drop_empty).groupBy("word").agg(F.count("*").alias("n"))


def word_sum(df: DataFrame, text: str, drop_empty: bool = False) -> DataFrame:
    """The same counts from pairs (word, 1) added up per word."""
    pairs = words_of(df, text, drop_empty).withColumn("one", F.lit(1))
    return pairs.groupBy("word").agg(F.sum("one").alias("n"))


def first_lines(df: DataFrame, text: str, order: str, n: int = 10) -> DataFrame:
    """The first ``n`` lines in text order.

    A text that is not empty has a line, so the first ``n`` such texts hold
    them all and no other text has to be cut into lines.
    """
    holders = df.select(order, text).filter(F.col(text) != "").orderBy(order).limit(n)
    return text_lines(holders, text, [order]).orderBy(order, "line_no").limit(n)
