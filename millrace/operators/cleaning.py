"""Cleaning of text-typed numbers and repeatable splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numeric import to_double


def clean_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cast the columns to double, drop rows with any null, drop repeated rows.

    Nulls and repeats are judged over all columns of the frame, not only over
    the cast ones. A value that is no number makes its row a dropped row.
    """
    return df.withColumns({c: to_double(F.col(c)) for c in columns}).na.drop("any").distinct()


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's random split; the parts depend on how the input is partitioned."""
    return df.randomSplit(weights, seed)


def split_side(keys: list[str], share: float, seed: int = 0) -> Column:
    """True for about ``share`` of the keys, decided by the key alone.

    The side of a row does not change when the data is repartitioned, when a
    lost task is run again or when rows are added.
    """
    if not 0 <= share < 1:
        raise ValueError("share is at least 0 and below 1")
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    # Digests are hexadecimal text, so they compare like numbers.
    return digest < F.lit(f"{int(share * 2**32):08x}")


def keyed_split(
    df: DataFrame, keys: list[str], share: float, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Two parts by ``split_side``: about ``share`` of the keys, and the rest."""
    side = split_side(keys, share, seed)
    return df.filter(side), df.filter(~side)
