"""CSV rows that do not parse: told apart from good ones, counted and put aside.

Spark keeps the raw line of a row it could not read under the schema. Here every
row carries that line, the file it stands in and what is wrong with it, in batches
and in streams alike: ``fields`` for a wrong number of fields, ``value`` for a field
that is not of its type. Empty fields are null and no fault.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.types import StringType, StructType

LINE, FILE, PROBLEM = "bad_line", "file", "problem"


def _fields(schema: StructType | str) -> StructType:
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    taken = {name.lower() for name in fields.names} & {LINE, FILE, PROBLEM}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are added here; rename those of the schema")
    return fields


def _told_apart(
    reader: DataFrameReader | DataStreamReader, path, schema: StructType, sep: str, header: bool
) -> DataFrame:
    rows = (
        reader.schema(StructType([*schema.fields]).add(LINE, StringType()))
        .option("sep", sep)
        .option("header", header)
        .option("columnNameOfCorruptRecord", LINE)
        .csv(path)
    )
    # Only fields that are asked for are parsed, so the raw line leans on all of them.
    named = [F.col(f"`{name}`") for name in schema.names]
    all_null = reduce(Column.__and__, [column.isNull() for column in named])
    nothing = F.when(all_null, F.lit(None).cast("string")).otherwise("")
    line = F.nullif(F.coalesce(F.col(LINE), nothing), F.lit("")).alias(LINE)
    file = F.col("_metadata.file_path").alias(FILE)
    return rows.select(*named, line, file).withColumn(PROBLEM, _problem(schema, sep))


def _problem(schema: StructType, sep: str) -> Column:
    """The bad line once more as texts only: what still fails has not the right fields."""
    texts = ", ".join(f"c{i} string" for i in range(len(schema.names))) + ", rest string"
    again = F.from_csv(F.col(LINE), texts, {"sep": sep, "columnNameOfCorruptRecord": "rest"})
    fault = F.when(again["rest"].isNotNull(), "fields").otherwise("value")
    return F.when(F.col(LINE).isNotNull(), fault)


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """The rows of CSV files under a schema, with ``bad_line``, ``file`` and ``problem``.

    All three but ``file`` are null in good rows. A bad row keeps the fields that
    could be read.
    """
    return _told_apart(spark.read, path, _fields(schema), sep, header)


def checked_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    sep: str = ",",
    header: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """The same for files that arrive under a folder."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _told_apart(reader, path, _fields(schema), sep, header)


def good_rows(rows: DataFrame) -> DataFrame:
    """Rows that parsed, in the columns of the schema."""
    return rows.filter(F.col(PROBLEM).isNull()).drop(LINE, FILE, PROBLEM)


def bad_rows(rows: DataFrame) -> DataFrame:
    """File, problem and raw line of the others."""
    return rows.filter(F.col(PROBLEM).isNotNull()).select(FILE, PROBLEM, LINE)


def problem_counts(rows: DataFrame) -> DataFrame:
    """Rows of each file: all, good ones, and bad ones by problem."""
    return rows.groupBy(FILE).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(PROBLEM).isNull()).alias("good"),
        F.count_if(F.col(PROBLEM) == "fields").alias("fields"),
        F.count_if(F.col(PROBLEM) == "value").alias("value"),
    )


def put_aside(rows: DataFrame, path: str) -> DataFrame:
    """Write the bad rows to ``path``, a folder for each problem, and give the good ones."""
    bad_rows(rows).write.partitionBy(PROBLEM).parquet(path)
    return good_rows(rows)


def start_checked(
    rows: DataFrame, good_path: str, bad_path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Good and bad rows of a stream to two tables, a folder for each batch.

    A batch that is run again replaces its own folders only, so each row is there
    once. ``every`` as in ``streaming.files.start_to_parquet``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            good_rows(kept).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            bad_rows(kept).write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        finally:
            kept.unpersist()

    timing = {"processingTime": every} if every else {"availableNow": True}
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .start()
    )
