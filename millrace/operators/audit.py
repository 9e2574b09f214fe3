"""Bracket audit of a text table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.brackets import is_balanced


def bracket_audit(df: DataFrame, text: str, by: list[str]) -> DataFrame:
    """Texts with balanced and with unbalanced brackets per group, and missing (null) ones.

    The three counts add up to the rows of the group.
    """
    flagged = df.select(*by, is_balanced(F.col(text)).alias("balanced"))
    return flagged.groupBy(*by).agg(
        F.count_if(F.col("balanced")).alias("balanced"),
        F.count_if(~F.col("balanced")).alias("unbalanced"),
        F.count_if(F.col("balanced").isNull()).alias("missing"),
    )
