"""Parquet tables, inline rows and named relations."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def inline(spark: SparkSession, rows: Iterable, schema: StructType | str | list[str]) -> DataFrame:
    """A small table from rows written in the program (tuples or scalars)."""
    return spark.createDataFrame(list(rows), schema)


def query(spark: SparkSession, text: str, **relations: DataFrame) -> DataFrame:
    """Run SQL text over named frames.

    The frames are passed as query arguments, so no session-wide view is left
    behind and two callers may use the same relation name.
    """
    return spark.sql(text, **relations)


def name_relation(df: DataFrame, name: str) -> None:
    """Make the frame known to ``spark.sql`` for the rest of the session."""
    df.createOrReplaceTempView(name)
