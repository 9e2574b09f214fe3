"""Prime factors and sums of squares."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.factors import prime_factors
from millrace.functions.numeric import array_total, squares


def with_factors(df: DataFrame, column: str, name: str = "factors") -> DataFrame:
    """Add the prime factors of a column to every row; nothing is shuffled."""
    return df.withColumn(name, prime_factors(F.col(column)))


def factor_histogram(df: DataFrame, column: str) -> DataFrame:
    """How often each prime occurs over all rows.

    Rows are counted per number first, so a number is factored once however
    many rows hold it.
    """
    counted = df.groupBy(column).agg(F.count("*").alias("copies"))
    return (
        with_factors(counted, column)
        .select("copies", F.explode("factors").alias("factor"))
        .groupBy("factor")
        .agg(F.sum("copies").alias("n"))
    )


def square_sum(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Sum of the squares of a column per group."""
    value = F.col(column).cast("bigint")
    return df.groupBy(*by).agg(F.sum(value * value).alias("square_sum"))


def with_square_sum(df: DataFrame, values: str, name: str = "square_sum") -> DataFrame:
    """Sum of the squares of an array column, row by row."""
    as_double = F.col(values).cast("array<double>")
    return df.withColumn(name, array_total(squares(as_double)))
