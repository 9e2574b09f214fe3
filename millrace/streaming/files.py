"""File streams and the places their results go."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.session import fresh_path, remove_path


def csv_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """CSV files arriving under a folder or glob; a stream needs its schema given.

    ``files_per_batch`` bounds what one batch reads, also when a backlog has
    gathered; without it a batch takes all there is.
    """
    reader = spark.readStream.schema(schema).option("sep", sep).option("header", header)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(path)


def parquet_stream(
    spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet files arriving under a folder or glob; ``files_per_batch`` as for CSV."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_to_table(
    result: DataFrame, name: str, limit: int, timeout: int | None = None
) -> DataFrame:
    """Read all files there are, keep the last complete result in memory.

    The rows end up on the driver, so there are ``limit`` of them at most; the
    result should be sorted. The stream's state is deleted afterwards.
    """
    spark = result.sparkSession
    state = fresh_path(spark, f"stream-{name}")
    query = (
        result.limit(limit)
        .writeStream.format("memory")
        .queryName(name)
        .outputMode("complete")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    _finish(query, timeout)
    remove_path(spark, state)
    return spark.table(name)


def start_to_parquet(
    result: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Write each complete result as parquet under ``path/batch=<id>``.

    A batch that is run again after a failure replaces its own folder only.
    ``every`` such as "1 minute" keeps the query running; without it the
    query ends once the present files are read.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    timing = {"processingTime": every} if every else {"availableNow": True}
    return (
        result.writeStream.foreachBatch(write)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .start()
    )


def run_to_parquet(result: DataFrame, path: str, timeout: int | None = None) -> DataFrame:
    """Read all files there are and return the last complete result."""
    spark = result.sparkSession
    state = fresh_path(spark, "stream-state")
    query = start_to_parquet(result, path, state)
    _finish(query, timeout)
    remove_path(spark, state)
    batches = [p["batchId"] for p in query.recentProgress if p["numInputRows"] > 0]
    if not batches:
        return spark.createDataFrame([], result.schema)
    return spark.read.schema(result.schema).parquet(f"{path}/batch={max(batches)}")


def start_to_console(result: DataFrame, rows: int = 10) -> StreamingQuery:
    """Print the leading rows of every complete result, for trying things out.

    Only those rows reach the driver. State and offsets go to the shared folder.
    """
    return (
        result.limit(rows)
        .writeStream.format("console")
        .outputMode("complete")
        .option("numRows", rows)
        .option("checkpointLocation", fresh_path(result.sparkSession, "stream-console"))
        .start()
    )


def _finish(query: StreamingQuery, timeout: int | None) -> None:
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout} seconds")
