"""Bracket balance of a text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_balanced(text: Column) -> Column:
    """True when every ``)`` closes an earlier ``(`` and none stays open.

    Texts without brackets are settled by a search; the rest fold over their
    brackets only. A depth below zero is final.
    """
    brackets = F.regexp_replace(text, r"[^()]+", "")
    depth = F.aggregate(
        F.split(brackets, ""),
        F.lit(0),
        lambda d, c: F.when(d < 0, d).when(c == "(", d + 1).when(c == ")", d - 1).otherwise(d),
    )
    present = F.contains(text, F.lit("(")) | F.contains(text, F.lit(")"))
    return F.when(~present, F.lit(True)).otherwise(depth == 0)
