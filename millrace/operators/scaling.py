"""Min-max scaling of columns and its inverse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Bounds = dict[str, tuple[float, float]]


def fit_bounds(df: DataFrame, columns: list[str]) -> Bounds:
    """Minimum and maximum of every column: one pass, one row to the driver."""
    found = df.agg(
        *[F.min(c).cast("double").alias(f"low_{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("double").alias(f"high_{i}") for i, c in enumerate(columns)],
    ).first()
    return {c: (found[f"low_{i}"], found[f"high_{i}"]) for i, c in enumerate(columns)}


def scaled(value: Column, bounds: tuple[float, float], low: float, high: float) -> Column:
    """Map ``bounds`` onto [low, high]; a constant column goes to the middle."""
    least, most = bounds
    if least is None or most == least:
        middle = F.lit((low + high) / 2)
        return F.when(value.isNotNull(), middle)
    return (value - F.lit(least)) / F.lit(most - least) * F.lit(high - low) + F.lit(low)


def unscaled(value: Column, bounds: tuple[float, float], low: float, high: float) -> Column:
    """The inverse of ``scaled``."""
    least, most = bounds
    return (value - F.lit(low)) / F.lit(high - low) * F.lit(most - least) + F.lit(least)


def minmax_scale(
    df: DataFrame,
    columns: list[str],
    low: float = -1.0,
    high: float = 1.0,
    suffix: str = "_scaled",
    bounds: Bounds | None = None,
) -> DataFrame:
    """Add each column mapped to [low, high], by given bounds or its own."""
    bounds = bounds or fit_bounds(df, columns)
    return df.withColumns(
        {c + suffix: scaled(F.col(c).cast("double"), bounds[c], low, high) for c in columns}
    )
