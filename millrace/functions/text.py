"""Lines, words and characters of a text column.

Plain string functions do the work where they can: they run over bytes, while
regular expressions and array lambdas visit characters and elements one by one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = " "


def text_body(text: Column) -> Column:
    """The text with \\n for every line end and none at its end; null if it has no line."""
    some = F.nullif(text, F.lit(""))
    unified = F.replace(F.replace(some, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    shorter = F.left(unified, F.length(unified) - 1)
    return F.when(F.endswith(unified, F.lit("\n")), shorter).otherwise(unified)


def without_loose_spaces(body: Column) -> Column:
    """The body, each line closed, without lines of spaces alone and spaces before line ends.

    Null for a body that has none of these, which is most of them.
    """
    closed = F.concat(body, F.lit("\n"))
    inked = F.regexp_replace(closed, r"(?dm)^ ++\n", "")
    loose = F.contains(body, F.lit(" \n")) | F.endswith(body, F.lit(SPACE))
    return F.when(loose, F.regexp_replace(inked, r"(?<! ) ++\n", "\n"))


def tight_body(body: Column, closed: Column) -> Column:
    """The body without loose spaces, given ``without_loose_spaces`` of it; null if nothing is left.

    A line end then separates words just as a space does. Let ``closed`` be a
    column of its own: it is used more than once.
    """
    opened = F.left(closed, F.length(closed) - 1)
    return F.when(closed.isNull(), body).when(closed != "", opened)


def body_words(body: Column) -> Column:
    """The words of a tight body."""
    return F.split(F.replace(body, F.lit("\n"), F.lit(SPACE)), SPACE)


def _none() -> Column:
    return F.array().cast("array<string>")


def lines(text: Column) -> Column:
    """The lines a text file with this content would be read as.

    Lines end at \\n, \\r\\n or \\r. A line end at the very end closes the last
    line and opens no new one; an empty or missing text has no line.
    """
    return F.coalesce(F.split(text_body(text), "\n"), _none())


def words(line: Column, drop_empty: bool = False) -> Column:
    """Split one line at single spaces.

    Spaces at the end yield nothing, spaces at the start or doubled inside
    yield empty words, an empty line yields one empty word and a line of
    spaces alone yields none. ``drop_empty`` leaves the empty words out.
    """
    kept = F.rtrim(line)
    parts = F.split(kept, SPACE)
    if drop_empty:
        return F.array_remove(parts, "")
    return F.when((kept == "") & (line != ""), _none()).otherwise(parts)


def text_words(text: Column, drop_empty: bool = False) -> Column:
    """The words of all lines of a text, in order."""
    if drop_empty:
        return F.coalesce(F.array_remove(body_words(text_body(text)), ""), _none())
    body = text_body(text)
    return F.coalesce(body_words(tight_body(body, without_loose_spaces(body))), _none())


def non_space_chars(text: Column) -> Column:
    """UTF-16 units other than the space; line ends do not count, tabs do. 0 for null."""
    bare = F.replace(F.replace(text, F.lit(SPACE), F.lit("")), F.lit("\n"), F.lit(""))
    without_cr = F.replace(bare, F.lit("\r"), F.lit(""))
    bare = F.when(F.contains(text, F.lit("\r")), without_cr).otherwise(bare)
    units = F.octet_length(F.encode(bare, "UTF-16BE")) / 2
    return F.coalesce(units, F.lit(0)).cast("bigint")
