"""Tolerant casts, label flags and array arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(value: Column) -> Column:
    """Text to double; null where the text is no number."""
    return value.try_cast("double")


def to_int(value: Column) -> Column:
    """Narrow to int; null where the value does not fit."""
    return value.try_cast("int")


def label_flag(label: Column, good: str) -> Column:
    """0 where the label contains ``good``, else 1; a missing label counts as 1."""
    return F.when(label.contains(good), 0).otherwise(1)


def squares(values: Column) -> Column:
    return F.transform(values, lambda v: v * v)


def array_total(values: Column) -> Column:
    """Fold an array column by addition, in double precision."""
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + v.cast("double"))


def line_value(slope: Column | float, x: Column | float, intercept: Column | float) -> Column:
    """``slope * x + intercept``."""
    as_column = [v if isinstance(v, Column) else F.lit(v) for v in (slope, x, intercept)]
    return as_column[0] * as_column[1] + as_column[2]
