"""Running totals: the batch aggregates applied to a stream.

Complete output needs every key in state, and repeats the whole result each
batch. That suits keys such as days, whose number is small; a key as numerous
as the rows would make the state grow without end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from millrace.operators.totals import leaders, ranked, total_by


def running_totals(stream: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """All totals so far, largest first (complete output mode only)."""
    return ranked(total_by(stream, key, value, name), name, key)


def running_leaders(
    stream: DataFrame, key: str, value: str, n: int = 10, name: str = "total"
) -> DataFrame:
    """The ``n`` largest totals so far."""
    return leaders(total_by(stream, key, value, name), name, key, n)
