"""Grouped sums and the groups that lead them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_by(df: DataFrame, key: str, value: str, name: str = "total") -> DataFrame:
    """Sum of ``value`` (a column or an SQL expression) per key.

    Integer sums stay bigint. Works on batch and on streaming frames.
    """
    return df.selectExpr(key, f"({value}) AS {name}").groupBy(key).agg(F.sum(name).alias(name))


def ranked(df: DataFrame, measure: str, key: str) -> DataFrame:
    """Largest measure first; equal measures in key order."""
    return df.orderBy(F.desc(measure), F.asc(key))


def leaders(df: DataFrame, measure: str, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest measure, ties settled by key."""
    return ranked(df, measure, key).limit(n)


def top_groups(df: DataFrame, key: str, value: str, n: int = 10, name: str = "total") -> DataFrame:
    """The ``n`` keys with the largest sum of ``value``."""
    return leaders(total_by(df, key, value, name), name, key, n)


def first_match(df: DataFrame, condition: str) -> DataFrame:
    """At most one row for which the condition holds; empty if there is none."""
    return df.filter(condition).limit(1)
