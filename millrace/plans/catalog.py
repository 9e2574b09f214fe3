"""All reports by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import corpus, extremes, models, sales, tidy

Report = Callable[[SparkSession, str], DataFrame]

_ALL = {
    **extremes.QUERIES,
    **sales.QUERIES,
    **tidy.QUERIES,
    **corpus.QUERIES,
    **models.QUERIES,
}


def reports() -> dict[str, Report]:
    return {name: report for name, (report, _) in _ALL.items()}


def equivalent_sql() -> dict[str, str]:
    return {name: sql.strip() for name, (_, sql) in _ALL.items() if sql is not None}
