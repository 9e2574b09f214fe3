"""Smallest and largest values, overall and by key, and column statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def global_extremes(df: DataFrame, low: str, high: str) -> DataFrame:
    """One row: the minimum of ``low`` and the maximum of ``high``, in one pass."""
    return df.agg(F.min(low).alias("lowest"), F.max(high).alias("highest"))


def extremes_by(df: DataFrame, key: str, low: str, high: str) -> DataFrame:
    """Minimum and maximum per key, largest key first, a null key last."""
    return (
        df.groupBy(key)
        .agg(F.min(low).alias("lowest"), F.max(high).alias("highest"))
        .orderBy(F.desc(key))
    )


def describe_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column.

    All columns are summarized in a single pass; the one resulting row is then
    unfolded. Values stay numeric (``DataFrame.describe`` gives them as text):
    minima and maxima are bigint where every column is an integer, which keeps
    them exact, and double otherwise.
    """
    whole = all(isinstance(df.schema[name].dataType, IntegralType) for name in columns)
    kind = "bigint" if whole else "double"
    summaries = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("n"),
            F.avg(name).alias("mean"),
            F.stddev_samp(name).alias("stddev"),
            F.min(name).cast(kind).alias("lowest"),
            F.max(name).cast(kind).alias("highest"),
        )
        for name in columns
    ]
    return df.agg(F.array(*summaries).alias("rows")).select(F.inline("rows"))


def describe_text(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, minimum and maximum of text columns, one row per column, in one pass.

    Texts compare by their bytes. Nulls are not counted; a column of nulls, or
    of a table without rows, has count 0 and null limits.
    """
    summaries = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("n"),
            F.min(name).cast("string").alias("lowest"),
            F.max(name).cast("string").alias("highest"),
        )
        for name in columns
    ]
    return df.agg(F.array(*summaries).alias("rows")).select(F.inline("rows"))
