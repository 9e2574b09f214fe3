"""CSV files: pinned or inferred schemas, one file or a glob."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Scan CSV files.

    Give ``schema`` for production reads. Without it Spark reads all the data
    once more to infer the types; do that once with ``infer_schema`` and pin
    the result. Unparsable and missing fields become null.
    """
    reader = spark.read.option("sep", sep).option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def infer_schema(
    spark: SparkSession, path: str | list[str], sep: str = ",", header: bool = True
) -> StructType:
    """The schema of CSV files, to be pinned for later scans and for streams."""
    return read_csv(spark, path, sep=sep, header=header).schema


def write_csv(df: DataFrame, path: str, sep: str = ",", rows_per_file: int = 0) -> None:
    """Write CSV shards, each with a header; padding around values is kept."""
    (
        df.write.option("sep", sep)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )
