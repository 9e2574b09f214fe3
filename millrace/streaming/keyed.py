"""A streamed result kept as a table with one row for each key.

The stream gives the keys that a batch has changed (update output). Each batch
writes those rows to a folder of its own, and every few batches the folders are
merged into one, the base, and deleted; so the table does not grow with the number
of batches, and a batch costs what it changes. A reader takes the newest row of a
key among the last base and the batches after it.

A batch that is run again after a failure replaces its own folder with the same
rows. A base counts once it is written whole; a merge that was cut short is
repeated, and what it should have deleted goes with the next one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from millrace.session import remove_path

MERGE_EVERY = 10


def _folders(spark: SparkSession, path: str, kind: str) -> dict[int, str]:
    """Complete folders by the number of their batch; a few, since merging deletes them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, f"{kind}=*/_SUCCESS")) or []
    folders = [status.getPath().getParent() for status in found]
    return {int(folder.getName().split("=")[1]): folder.toString() for folder in folders}


def keyed_table(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], upto: int | None = None
) -> DataFrame:
    """The rows as they stand, one for each key; ``upto`` a batch, all by default.

    Null is a key like any other. Merging deletes folders that earlier frames of
    this table read, so ask for a new frame after new batches.
    """
    bases, changes = _folders(spark, path, "base"), _folders(spark, path, "batch")
    if upto is not None:
        bases, changes = ({n: f for n, f in each.items() if n <= upto} for each in (bases, changes))
    last = max(bases, default=-1)
    parts = [(last, bases[last])] if bases else []
    parts += [(number, changes[number]) for number in sorted(changes) if number > last]
    rows = spark.createDataFrame([], schema).withColumn("batch_no", F.lit(0).cast("bigint"))
    for number, folder in parts:
        part = spark.read.schema(schema).parquet(folder)
        rows = rows.union(part.withColumn("batch_no", F.lit(number).cast("bigint")))
    newest = F.max_by(F.struct(*schema.names), "batch_no").alias("newest")
    return rows.groupBy(*keys).agg(newest).select("newest.*")


def write_changes(
    batch: DataFrame, number: int, path: str, keys: Sequence[str], merge_every: int = MERGE_EVERY
) -> None:
    """Put the changed rows of a batch into the table."""
    batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
    if (number + 1) % merge_every == 0:
        merge(batch.sparkSession, path, batch.schema, keys, number)


def merge(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], upto: int) -> None:
    """One base of all batches up to ``upto``; what it holds is deleted elsewhere."""
    if upto not in _folders(spark, path, "base"):
        whole = keyed_table(spark, path, schema, keys, upto)
        whole.write.mode("overwrite").parquet(f"{path}/base={upto}")
    bases, changes = _folders(spark, path, "base"), _folders(spark, path, "batch")
    done = [f for n, f in bases.items() if n < upto] + [f for n, f in changes.items() if n <= upto]
    for folder in done:
        remove_path(spark, folder)


def start_keyed(
    result: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    every: str | None = None,
    merge_every: int = MERGE_EVERY,
) -> StreamingQuery:
    """Keep the result of a grouped stream under ``path``.

    Start it again with the same ``checkpoint`` and it goes on where it stopped.
    ``every`` as in ``files.start_to_parquet``.
    """
    keys = list(keys)

    def write(batch: DataFrame, number: int) -> None:
        write_changes(batch, number, path, keys, merge_every)

    timing = {"processingTime": every} if every else {"availableNow": True}
    return (
        result.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .start()
    )
